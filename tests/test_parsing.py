"""Hand-written edge lines for both parse dialects, golden values in the test."""

import datetime as dt

import pytest

from pintulog.operators import counters, filters, parsing
from pintulog.plans import reports
from pintulog.sources.lines import decode_lines


def block(text):
    return f"Metric Name: apim:response, Metric Value: {{{text}}}"


def both(lines, text, *names):
    """Named fields of one block in the regex and the map dialect."""
    records = decode_lines(lines(block(text)))
    regex = parsing.extract_text_fields(records).select(*names).collect()
    typed = parsing.typed_events(records).select(*names).collect()
    return [tuple(r) for r in regex], [tuple(r) for r in typed]


@pytest.mark.parametrize(
    "text, names, regex, typed",
    [
        ("apiName=a, apiName=b", ["apiName"], ("a",), ("b",)),
        ("backendLatency=12ms, apiType=HTTP", ["backendLatency"], ("12",), (None,)),
        ("backendLatency=-1, apiType=HTTP", ["backendLatency"], (None,), (None,)),
        ("backendLatency=99999999999, apiType=H", ["backendLatency"], ("99999999999",), (None,)),
        ("apiName=, apiType=HTTP", ["apiName"], (None,), (None,)),
        ("apiName=x, apiName, apiType=HTTP", ["apiName"], ("x",), ("x",)),
        ("apiName, apiType=HTTP", ["apiName", "apiType"], (None, "HTTP"), (None, "HTTP")),
        ("apiName=a,b, apiType=HTTP", ["apiName"], ("a",), ("a,b",)),
        ("apiName=k=v, apiType=HTTP", ["apiName"], ("k=v",), ("k=v",)),
        ("apiName=a, apiType=HTTP", ["apiName", "apiType"], ("a", "HTTP"), ("a", "HTTP")),
        ("apiType=HTTP, apiName=a", ["apiName"], ("a}",), ("a",)),
    ],
)
def test_dialects(lines, text, names, regex, typed):
    assert both(lines, text, *names) == ([regex], [typed])


def test_a_brace_in_a_value_ends_the_map_block_only(lines):
    regex, typed = both(
        lines, "apiResourceTemplate=/v1/{id}, userIp=1.1.1.1", "apiResourceTemplate", "userIp"
    )
    assert regex == [("/v1/{id}", "1.1.1.1}")]
    assert typed == [("/v1/{id", None)]


def test_cache_hit_is_false_when_present_and_null_when_absent(lines):
    texts = ["responseCacheHit=TRUE", "responseCacheHit=no", "responseCacheHit=", "apiName=a"]
    rows = decode_lines(lines(*[block(t) for t in texts]))
    got = parsing.typed_events(rows, "id").orderBy("id").collect()
    assert [r.responseCacheHit for r in got] == [True, False, False, None]


def test_request_time_keeps_the_wall_clock_and_bad_ones_drop_the_row(lines):
    rows = decode_lines(
        lines(
            block("requestTimestamp=2025-06-16T10:00:00+07:00, apiType=HTTP"),
            block("requestTimestamp=junk, apiType=HTTP"),
            block("requestTimestamp=, apiType=HTTP"),
        )
    )
    got = parsing.typed_events(rows, "id").orderBy("id").collect()
    assert [(r.id, r.requestTimestamp) for r in got] == [
        (0, dt.datetime(2025, 6, 16, 10)),
        (2, None),
    ]


def test_block_keys_override_stream_and_time(lines):
    rows = decode_lines(
        lines(block("stream=s2, time=2025-06-17T00:00:00"), block("stream="), block("apiName=a"))
    )
    got = parsing.typed_events(rows, "id").orderBy("id").collect()
    assert [(r.stream, r.time) for r in got] == [
        ("s2", dt.datetime(2025, 6, 17)),
        (None, dt.datetime(2025, 6, 16, 10)),
        ("stdout", dt.datetime(2025, 6, 16, 10)),
    ]


def test_lines_without_a_block(lines):
    rows = decode_lines(lines("plain text apiName=x, rest", block(""), "Metric Value: {a=1"))
    assert [r.id for r in parsing.typed_events(rows, "id").collect()] == [1]
    regex = parsing.analysis_fields(rows, "id").orderBy("id").collect()
    assert [r.apiName for r in regex] == ["x", None, None]


def test_nanoseconds_are_cut_and_missing_time_survives_the_typed_parse_only(lines):
    raw = ['{"log":"%s","stream":"stdout"}' % block("apiName=a")]
    both_lines = lines(block("apiName=b"), time="2025-06-16T10:00:00.123456789Z", raw=raw)
    assert decode_lines(both_lines).count() == 1
    typed = parsing.typed_events(decode_lines(both_lines, require_time=False), "id")
    got = typed.orderBy("id").collect()
    assert [r.time for r in got] == [dt.datetime(2025, 6, 16, 10, 0, 0, 123456), None]


def test_metric_map_keeps_the_last_value_without_session_settings(lines):
    rows = decode_lines(lines(block("a=1, b=TRUE, a=x=y, junk, c=7, d="), block("n=5")))
    maps = parsing.metric_maps(rows, "id").orderBy("id").collect()
    assert maps[0].metrics == {"a": "x=y", "b": "TRUE", "c": "7", "d": ""}
    assert maps[1].metrics == {"n": "5"}
    long = parsing.metric_values_long(rows, "id").where("id = 0").collect()
    got = {r.key: (r.kind, r.str_value, r.int_value, r.bool_value) for r in long}
    assert got == {
        "a": ("str", "x=y", None, None),
        "b": ("bool", None, None, True),
        "c": ("int", None, 7, None),
        "d": ("str", "", None, None),
    }


def test_unreadable_lines_are_skipped_and_counted(lines):
    raw = [
        "   ", "", "oops{", "5", '{"log":"x"}', '{"log":{"a":1},"time":"t"}',
        '{"log":"a","time":"t"} trailing', '{"log":null,"time":"t"}', "{'log':'a','time':'t'}",
    ]
    frame = lines("fine", raw=raw)
    assert [r.log for r in decode_lines(frame).collect()] == ["fine"]
    quality = counters.line_quality(frame).first()
    assert quality.asDict() == {"lines": 10, "non_blank": 8, "decoded": 2, "complete": 1}


def test_records_are_told_by_json_type(lines):
    raw = [
        '{"log":"{\\"level\\":1} apiName=x","time":"t"}', '{"log":["apiName=arr"],"time":"t"}', '{"log":5,"time":"t"}',
        '{"log":"tab","time":"t"}\t', '{"log":"a","time":"t"} {"log":"b","time":"t"}', '{"log":"a","time":"t"}}',
        '{"log":"a","time":"t"}],[{"log":"b"}', '{"log":"a","time":"t"},{"log":"b"}', ' {"log":"first","log":"last","time":"t"}\r',
    ]
    assert [r.log for r in decode_lines(lines(raw=raw)).collect()] == ['{"level":1} apiName=x', "tab", "last"]


def test_digits_beyond_64_bits_are_kept(lines):
    rows = decode_lines(lines(block("applicationId=12345678901234567890")))
    value = parsing.metric_values_long(rows, "id").first()
    assert (value.kind, value.str_value) == ("str", "12345678901234567890")
    late = decode_lines(lines("backendLatency=99999999999999999999, apiName=x,"))
    assert parsing.extract_row(late, "id").first().backend_latency is None


def test_observed_counters_need_no_pass_of_their_own(lines):
    frame, seen = counters.counted(
        counters.parsed_lines(lines("a", "b", raw=["oops"])), "scan", *counters.line_counters()
    )
    frame.collect()
    assert seen.get == {"lines": 3, "non_blank": 3, "decoded": 2, "complete": 2}


def test_scope_needs_a_tenant(lines):
    records = decode_lines(
        lines("apiCreatorTenantDomain=carbon.super, x", "apiCreatorTenantDomain=a.go.id, x", "none")
    )
    assert [r.id for r in filters.in_scope(records, "national").collect()] == [0]
    assert [r.id for r in filters.in_scope(records, "internal").collect()] == [1]
    with pytest.raises(ValueError):
        filters.in_scope(records, "both")


def test_cleansing_is_case_sensitive_and_reads_the_whole_line(lines):
    records = decode_lines(lines("ok", "x=latest", "Admin", "internal-key-app", "x" * 50000 + "demo"))
    assert [r.id for r in filters.cleansed(records).orderBy("id").collect()] == [0, 2]


def test_qualifying_calls_compare_null_safe(spark):
    rows = [
        (0, "a", "b", "200", "200"), (1, "a", "a", "200", "200"), (2, None, "b", "200", "200"),
        (3, None, None, "200", "200"), (4, "a", "b", "200", "500"), (5, "a", "b", None, "200"),
    ]
    frame = spark.createDataFrame(
        rows,
        "id int, apiCreator string, applicationOwner string, proxyResponseCode string, "
        "targetResponseCode string",
    )
    assert [r.id for r in frame.where(filters.qualifying_call()).orderBy("id").collect()] == [0, 2]


def test_qualifying_lines_are_the_qualifying_calls(lines):
    logs = [
        f"apiCreator={c}, applicationOwner={o}, proxyResponseCode={p}, targetResponseCode={t}, x"
        for c in ("a", "b", "") for o in ("a", "b", "") for p in ("200", "2000") for t in ("200", "")
    ]
    records = decode_lines(lines(*logs))
    by_line = records.where(filters.qualifying_line()).select("id").collect()
    by_call = parsing.analysis_fields(records, "id").where(filters.qualifying_call())
    assert sorted(by_line) == sorted(by_call.select("id").collect()) and by_line


def test_extract_defaults_and_strict_mode(lines):
    good = block("backendLatency=5, requestTimestamp=2025-06-16T10:00:00+07:00, x=1")
    row = reports.extract(lines(good)).first()
    assert (row.backend_latency, row.response_latency) == (5, 0)
    assert row.request_timestamp == dt.datetime(2025, 6, 16, 10)
    assert len(row) == 30
    with pytest.raises(Exception, match="no readable"):
        reports.extract(lines(good), strict=True).collect()


def test_time_range_compares_times_not_texts(lines):
    frame = lines("a", time="2025-06-16T10:00:00Z").unionByName(
        lines("b", time="2025-06-16T10:00:00.9Z")
    )
    kept = filters.time_range(decode_lines(frame), "2025-06-16T10:00:00", "2025-06-16T10:00:00.5")
    assert [r.log for r in kept.collect()] == ["a"]


def test_record_json_is_parsed_once_per_line(lines):
    records = filters.cleansed(filters.in_scope(decode_lines(lines("x")), "internal"))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("text, block", [
    ("Metric Value: {a=/v1/{id}, b=2}", "a=/v1/{id}, b=2"),
    ("Metric Value: {b=1, a=/{x}/{y{z}}, c=3} {d=4}", "b=1, a=/{x}/{y{z}}, c=3"),
    ("Metric Value: {a=1} Metric Value: {b=2}", "a=1"),
    ("Metric Value: {}", ""),
    ("Metric Value: {{}}, x}", "{}"),
    ("Metric Value: {a={b, c=1} end", "a={b, c=1"),
    ("Metric Value: {a={b}, c=1\n}", "a={b"),
    ("Metric Value: {a=1", None),
    ("no block", None),
])
def test_a_balanced_block_ends_at_its_own_brace(spark, text, block):
    frame = spark.createDataFrame([(text,)], "log string")
    found = [r.metrics for r in parsing.with_metrics(frame, balanced=True).collect()]
    assert found == ([] if block is None else [", " + block])
    if block is not None and "{" not in block:
        assert [r.metrics for r in parsing.with_metrics(frame).collect()] == found


def test_keys_after_a_path_are_read_on_request_only(spark):
    log = "Metric Value: {apiResourceTemplate=/v1/{id}, userIp=1.1.1.1, backendLatency=7}"
    frame = spark.createDataFrame([(log, "2025-06-16T00:00:00Z", "s")], "log string, time string, stream string")
    default, whole = (parsing.typed_events(frame, balanced=b).first() for b in (False, True))
    assert (default.apiResourceTemplate, default.userIp, default.backendLatency) == ("/v1/{id", None, None)
    assert (whole.apiResourceTemplate, whole.userIp, whole.backendLatency) == ("/v1/{id}", "1.1.1.1", 7)


def test_typed_events_go_over_a_block_once_and_read_odd_pairs(spark, lines):
    blocks = {
        "apiName=a, platform=b=c, userIp=1,2,,3,": ("a", "b=c", "1,2,,3,"),
        "platform=x, apiName=first, noise, apiName=, userIp=9, platform=last": (None, "last", "9"),
        'apiName=say "hi" \\ c:\\n, pl=1, "userIp"=q, platform=\\", userIp=\t\u0001\u00e9\U0001f600': ('say "hi" \\ c:\\n', '\\"', "\t\u0001\u00e9\U0001f600"),
        "x.apiName=1,  apiName=2, =3, platform, userIp=$1{$2, " + "k" * 70_000 + "=1": (None, None, "$1{$2"),
        "": (None, None, None),
        "=, , apiName=ok": ("ok", None, None),
        "apiName=" + "," * 20_000: ("," * 20_000, None, None),
    }
    frame = decode_lines(lines(*[f"Metric Value: {{{block}}}" for block in blocks]))
    events = parsing.typed_events(frame, "id")
    got = {r.id: (r.apiName, r.platform, r.userIp) for r in events.collect()}
    assert [got[i] for i in range(len(blocks))] == list(blocks.values())
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1
