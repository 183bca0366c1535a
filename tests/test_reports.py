"""Reports, catalog refresh, landing and streams."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from acceptance import fixtures as fx
from pintulog import sinks
from pintulog.operators import upsert, usage
from pintulog.plans import catalog as catalog_plan
from pintulog.plans import ingest, reports
from pintulog.schemas import CATALOG_DDL, EVENT_DDL, MAPPING_DDL, USAGE_DDL, fields
from pintulog.session import tune
from pintulog.shared import settle, shared_folder
from pintulog.sources import tables
from pintulog.sources.envelope import flatten_pages
from pintulog.sources.lines import decode_lines, read_day_lines, read_lines, undated_files
from pintulog.streaming import hits as stream_hits
from pintulog.streaming import folders, runs

SF = "/root/testdata/sf0.001"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def call(creator="c", owner="o", api="a", tenant="t.go.id", code="200", ip="1.1.1.1"):
    return (
        f"Metric Name: apim:response, Metric Value: {{apiName={api}, proxyResponseCode={code}, "
        f"apiCreatorTenantDomain={tenant}, apiCreator={creator}, applicationOwner={owner}, "
        f"applicationName=app, userIp={ip}, targetResponseCode={code}, x=1}}"
    )


# --- reports ------------------------------------------------------------------------


def test_recap_scans_and_parses_the_log_once(spark):
    tune(spark)
    frame = reports.recap(fx.lines(spark, SF), fx.mapping(spark, SF), "internal", cleanse=True)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.rindex("== Initial Plan ==")]
    assert "ReusedExchange" in final
    assert "NestedLoop" not in final and "Cartesian" not in final


def test_recap_keeps_null_keys_and_labels(lines, mapping):
    logs = [call(), call(), call(owner="c"), call(code="500"), call(creator="nan@t.go.id")]
    no_ip = call().replace(", userIp=1.1.1.1", "")
    table = mapping(("c", "t.go.id", "Inst T", "Kota"), (None, None, "hole", "Kota"))
    got = rows(reports.recap(lines(*logs, no_ip), table, "internal", cleanse=False))
    tail = ("t.go.id", "o", "app")
    assert got == sorted(
        [
            ("Tidak Terdaftar", "c", "a", "Tidak Terdaftar", *tail, "1.1.1.1", 2),
            ("Tidak Terdaftar", "c", "a", "Tidak Terdaftar", *tail, None, 1),
            ("Inst T", "nan@t.go.id", "a", "Tidak Terdaftar", *tail, "1.1.1.1", 1),
        ],
        key=str,
    )


def test_daily_recap_lists_only_days_with_calls_and_sums_up(lines, mapping):
    stems = F.when(F.col("id") < 2, "logs_2025-06-17").when(F.col("id") < 4, "logs_2025-06-16")
    frame = lines(call(), call(), call(), call(ip="2"), call(code="404")).withColumn(
        "file_stem", stems.otherwise("logs_2025-06-18")
    )
    wide = reports.recap_daily(frame, mapping(("o", None, "O", "Kota")), "internal", cleanse=False)
    assert wide.columns == [*reports.RECAP_COLUMNS, "logs_2025-06-16", "logs_2025-06-17"]
    got = {r.userIp: tuple(r)[-3:] for r in wide.collect()}
    assert got == {"1.1.1.1": (3, 1, 2), "2": (1, 1, 0)}
    by_date = frame.withColumn("day", F.substring_index("file_stem", "_", -1))
    named = reports.recap_daily(
        by_date, mapping(), "internal", cleanse=False, days=["2025-06-16"], day_column="day"
    )
    assert named.columns[-1] == "2025-06-16"


def test_hit_summary_takes_the_earliest_peak_and_survives_no_hits(spark):
    hits = spark.createDataFrame(
        [("2025-06-16 00:00:05", 3), ("2025-06-16 00:00:02", 3), ("2025-06-16 00:00:01", 1)],
        "second string, hits bigint",
    )
    summary = usage.hits_summary(hits)
    assert tuple(summary.first()) == (3, "2025-06-16 00:00:02", 3, pytest.approx(7 / 3))
    assert tuple(usage.hits_summary(hits.limit(0)).first()) == (0, None, 0, None)
    table = {r.metric: r.value for r in usage.summary_rows(summary).collect()}
    assert table["Maximum Concurrent Hits"] == "3" and table["Total Unique Seconds"] == "3"


def test_wall_clock_seconds_ignore_the_session_zone(spark, lines):
    frame = decode_lines(lines("a", "b", time="2025-03-09T02:30:00.5Z", raw=[line("c", "junk")]))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(usage.hits_per_second(frame)) == [("2025-03-09 02:30:00", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def extract_frame(spark, *stamps, name="a"):
    return spark.createDataFrame(
        [(s, name, "nation_1", "req", "app") for s in stamps],
        "log_timestamp string, api_name string, api_creator string, application_owner string, "
        "application_name string",
    )


def test_usage_by_date_checks_dates_and_drops_missing_keys(spark, mapping):
    table = mapping(("nation_1", None, "N1", "Kota"), ("requester", None, "", "Kota"))
    good = extract_frame(spark, " 2025-06-16 10:00:00 ", "2025-06-16 11:00:00")
    bad = good.unionByName(extract_frame(spark, "16-06-2025x 1"))
    got = rows(reports.usage_by_date(good, table))
    assert got == [("2025-06-16", "N1", "a", "nation_1", "Tidak Terdaftar", "req", "app", 2)]
    assert rows(reports.usage_by_date(bad, table, on_bad_date="skip")) == got
    assert rows(reports.bad_dates(bad)) == [("16-06-2025x",)]
    with pytest.raises(Exception, match="not a date: 16-06-2025x"):
        reports.usage_by_date(bad, table).collect()
    holes = good.unionByName(extract_frame(spark, "2025-06-16 1", name=None))
    holes = holes.unionByName(extract_frame(spark, "2025-06-16 1", name=""))
    assert rows(reports.usage_by_date(holes, table)) == got
    texts = good.unionByName(extract_frame(spark, "2025-06-16 1", name="NA"))
    assert len(rows(reports.usage_by_date(texts, table))) == 2
    assert rows(reports.usage_by_date(texts, table, pandas_na=True)) == got


def test_accumulate_drops_null_keys_and_reads_no_counts_as_zero(spark):
    frame = spark.createDataFrame(
        [
            ("i", "c", "a", "t", 1), ("i", "c", "a", "t", 2), ("i", "c", "b", "t", None),
            ("i", None, "a", "t", 9),
        ],
        USAGE_DDL,
    )
    assert rows(usage.accumulate(frame)) == [("i", "c", "a", "t", 3), ("i", "c", "b", "t", 0)]


# --- catalog ------------------------------------------------------------------------


def catalog_case(spark):
    catalog = spark.createDataFrame(
        [
            ("p", "c", "a", "1", "nasional", "PUBLISHED", "X", None),
            ("p", "c", "a", "2", "nasional", "RETIRED", "X", 5),
            ("p", "c", "b", "1", "t.id", "PUBLISHED", None, 7),
            ("p", None, "b", "1", "t.id", "PUBLISHED", None, 8),
        ],
        CATALOG_DDL,
    )
    national = spark.createDataFrame(
        [("I1", "c", "a", "carbon.super", 10), ("I2", "d", "a", "carbon.super", 1)], USAGE_DDL
    )
    internal = spark.createDataFrame(
        [("I3", "d", "a", "nasional", 2), ("I4", "e", "z", "t.id", 4)], USAGE_DDL
    )
    return catalog, national, internal


def test_upsert_updates_all_versions_and_appends_the_rest(spark):
    catalog, national, internal = catalog_case(spark)
    got = rows(catalog_plan.refresh_catalog(catalog, national, internal))
    assert got == sorted(
        [
            ("p", "c", "a", "1", "nasional", "PUBLISHED", "X", 10),
            ("p", "c", "a", "2", "nasional", "RETIRED", "X", 10),
            ("p", "c", "b", "1", "t.id", "PUBLISHED", None, 7),
            ("p", None, "b", "1", "t.id", "PUBLISHED", None, 8),
            ("d", "d", "a", None, "nasional", "PUBLISHED", "I2", 2),
            ("e", "e", "z", None, "t.id", "PUBLISHED", "I4", 4),
        ],
        key=str,
    )


def test_upsert_in_one_pass_equals_one_table_after_the_other_and_is_idempotent(spark):
    catalog, national, internal = catalog_case(spark)
    once = catalog_plan.refresh_catalog(catalog, national, internal)
    step = catalog_plan.refresh_catalog(catalog, national)
    assert rows(catalog_plan.refresh_catalog(step, internal)) == rows(once)
    assert rows(catalog_plan.refresh_catalog(once, national, internal)) == rows(once)


def test_upsert_adds_a_missing_occurrence_column(spark):
    catalog, national, _ = catalog_case(spark)
    got = catalog_plan.refresh_catalog(catalog.drop("occurrence"), national)
    counts = {(r.api_name, r.api_version): r.occurrence for r in got.collect()}
    assert counts[("a", "1")] == counts[("a", "2")] == 10 and counts[("b", "1")] is None
    assert upsert.with_occurrence(catalog) is catalog


# --- landing ------------------------------------------------------------------------


def write_files(folder, files):
    folder.mkdir()
    for name, content in files.items():
        (folder / name).write_text("".join(line + "\n" for line in content))
    return str(folder)


def line(log, time):
    return json.dumps({"log": log, "time": time, "stream": "stdout"})


@pytest.fixture
def day_files(tmp_path):
    return write_files(
        tmp_path / "logs",
        {
            "logs_2025-06-16.txt": [line(call(api="late"), "2025-06-16T09:00:00Z"), "", "oops",
                                    line(call(api="early"), "2025-06-16T08:00:00Z")],
            "logs_2025-06-17.txt": [line(call(), "2025-06-17T08:00:00Z")],
            "logs_2025-06-18.txt": [line(call(), "2025-06-18T08:00:00Z")],
            "logs_notes.txt": [line(call(), "2025-06-18T08:00:00Z")],
            "readme.md": ["nothing"],
        },
    )


def test_date_bounds_choose_files_without_opening_the_others(spark, day_files):
    got = read_lines(spark, day_files, "2025-06-16", "2025-06-17")
    assert {r.file_stem for r in got.collect()} == {"logs_2025-06-16", "logs_2025-06-17"}
    assert read_lines(spark, day_files).where("file_stem = 'readme'").count() == 1
    day = read_day_lines(spark, day_files, "2025-06-17", "2025-06-17")
    assert {r.day for r in day.collect()} == {dt.date(2025, 6, 17)}
    plan = day._jdf.queryExecution().executedPlan()
    assert plan.collectLeaves().head().metrics().apply("numFiles").value() == 1
    assert rows(undated_files(spark, day_files)) == [("logs_notes.txt",)]


def test_ingest_replaces_only_the_days_it_writes(spark, day_files, tmp_path):
    target = str(tmp_path / "events")
    ingest.ingest_typed(spark, day_files, target)
    first = rows(tables.read_events(spark, target))
    assert [f.name for f in fields(EVENT_DDL)] + ["day"] == tables.read_events(spark, target).columns
    assert len(first) == 4
    ingest.ingest_typed(spark, day_files, target, "2025-06-17", "2025-06-17", compact=True)
    assert rows(tables.read_events(spark, target)) == first
    part = spark.read.schema(EVENT_DDL).parquet(f"{target}/day=2025-06-16")
    assert [r.apiName for r in part.collect()] == ["early", "late"]
    pruned = tables.read_events(spark, target, "2025-06-18")
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_pulled_records_land_under_the_day_of_their_time(spark, lines, tmp_path):
    frame = lines(call(), time="2025-06-16T23:59:59.9Z").unionByName(
        lines(call(), time="2025-06-17T00:00:00Z")
    )
    records = decode_lines(frame).drop("id")
    assert ingest.land_pulled_records(records, str(tmp_path / "text"), "a") == {"records": 2, "undated": 0}
    again = read_lines(spark, str(tmp_path / "text"))
    assert {r.file_stem for r in again.collect()} == {"logs_2025-06-16", "logs_2025-06-17"}
    assert rows(decode_lines(again).select("log", "time")) == rows(records.select("log", "time"))
    assert read_lines(spark, str(tmp_path / "text"), "2025-06-17").count() == 1
    assert read_day_lines(spark, str(tmp_path / "text"), None, "2025-06-16").count() == 1
    assert ingest.land_pulled_events(records, str(tmp_path / "events"), "a") == {"records": 2, "events": 2}
    days = {r.day for r in tables.read_events(spark, str(tmp_path / "events")).collect()}
    assert days == {dt.date(2025, 6, 16), dt.date(2025, 6, 17)}


def test_extract_round_trip_and_column_pruning(spark, lines, tmp_path):
    frame = lines(call(api='quo"te'), call(api="0012")).withColumn("file_stem", F.lit("logs_x"))
    extract = reports.extract(frame, "file_stem")
    for by, path in (("file_stem", "daily"), (None, "single")):
        out = extract if by else extract.drop("file_stem")
        sinks.write_extract(out, str(tmp_path / path), by)
        keys = tables.read_extract_keys(spark, str(tmp_path / path))
        assert {(r.log_timestamp, r.api_name) for r in keys.collect()} == {
            ("2025-06-16 10:00:00.000000", 'quo"te'), ("2025-06-16 10:00:00.000000", "0012"),
        }
        plan = keys._jdf.queryExecution().executedPlan().toString()
        assert "user_agent" not in plan[plan.index("ReadSchema"):]
    full = tables.read_extract(spark, str(tmp_path / "single"))
    assert full.columns == extract.drop("file_stem").columns


def test_reference_tables_and_reports_as_csv(spark, mapping, tmp_path):
    table = mapping(("a", "b", "c", "Kota"), ("d", None, "f", "Kota"))
    sinks.write_report(table, str(tmp_path / "mapping.csv"), ["ord"])
    back = tables.read_mapping(spark, str(tmp_path / "mapping.csv"))
    assert rows(back) == rows(table) and back.columns == [f.name for f in fields(MAPPING_DDL)]
    table.write.parquet(str(tmp_path / "mapping"))
    assert rows(tables.read_mapping(spark, str(tmp_path / "mapping"))) == rows(table)


def test_pages_flatten_over_series_and_skip_what_is_no_record(spark):
    good = lambda i: [str(i), line(f"log {i}", "2025-06-16T00:00:00Z")]
    page = {"data": {"result": [
        {"stream": {"container": "gateway"}, "values": [good(1), ["2", "oops"]]},
        {"stream": {"container": "other"}, "values": [good(3), ["4", '{"log":"x"}']]},
    ]}}
    empty = {"data": {"result": []}}
    frame = spark.createDataFrame(
        [(json.dumps(page),), (json.dumps(empty),), ("oops",)], "value string"
    )
    got = flatten_pages(frame).select("store_time", "log", F.col("labels")["container"])
    assert rows(got) == [(1, "log 1", "gateway"), (3, "log 3", "other")]


def test_settled_tables_live_where_the_session_says(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or shared_folder(spark).startswith(base)
    frame = spark.range(5).withColumn("x", F.lit("a"))
    again = settle(frame)
    assert rows(again) == rows(frame)
    assert again.inputFiles()


# --- streams ------------------------------------------------------------------------


def test_streamed_hits_equal_batch_hits(spark, tmp_path):
    lines = fx.lines(spark, SF).select("value", "file_stem")
    lines.repartition(6).select("value").write.text(str(tmp_path / "in"))
    stream = spark.readStream.option("maxFilesPerTrigger", 2).text(str(tmp_path / "in"))
    counts = stream_hits.stream_hits(stream, "national", cleanse=True, delay="30 days")
    got = runs.run_to_table(counts, str(tmp_path / "out"), str(tmp_path / "cp"), ["second"])
    assert rows(got) == rows(reports.hits(lines, "national", cleanse=True))


def land(spark, folder, tmp_path, files=1):
    stream = decode_lines(spark.readStream.option("maxFilesPerTrigger", files).text(folder))
    query = runs.land_once(stream.select("time", "log"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    return query


def landed(spark, tmp_path):
    return rows(runs.read_landed(spark, str(tmp_path / "out"), "log string, time string").select("log", "time"))


def test_repeated_records_land_once_however_late(spark, tmp_path):
    folder = write_files(tmp_path / "in", {
        "a.txt": [line("x", "2025-06-16T00:00:01Z"), line("y", "2025-06-16T00:00:01Z"), line("s", "soon")],
        "b.txt": [line("x", "2025-06-16T00:00:01Z"), line("x", "2025-06-16T00:00:02Z"), line("s", "soon"), line("s", "later")],
        "c.txt": [line("old", "2024-01-01T00:00:00Z"), line("z", ""), line("z", "")],
    })
    query = land(spark, folder, tmp_path)
    expected = [
        ("old", "2024-01-01T00:00:00Z"), ("s", "later"), ("s", "soon"), ("x", "2025-06-16T00:00:01Z"), ("x", "2025-06-16T00:00:02Z"),
        ("y", "2025-06-16T00:00:01Z"), ("z", ""),
    ]
    assert landed(spark, tmp_path) == expected
    # every line is read once, and no state is kept
    assert sum(p["numInputRows"] for p in query.recentProgress) == 10
    assert not any(p["stateOperators"] for p in query.recentProgress)
    (tmp_path / "in" / "d.txt").write_text(line("y", "2025-06-16T00:00:01Z") + "\n" + line("s", "later") + "\n")
    land(spark, folder, tmp_path)
    assert landed(spark, tmp_path) == expected


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    folder = write_files(tmp_path / "in", {f"{i}.txt": [line(f"x{i}", f"2025-06-1{i}T00:00:00Z"), line("again", "2025-06-16T00:00:00Z")] for i in range(4)})
    land(spark, folder, tmp_path)
    before = landed(spark, tmp_path)
    assert len(before) == 5
    last = sorted(p.name for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit())[-1]
    for name in (last, f".{last}.crc"):  # as if the process had died before it could say so
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    runs.compact_days(spark, str(tmp_path / "out"), "record_key binary, time string, log string", "9", least=1)
    land(spark, folder, tmp_path)
    assert landed(spark, tmp_path) == before


def test_many_small_files_of_a_day_become_few_and_a_kill_midway_loses_nothing(spark, tmp_path, monkeypatch):
    target, day = str(tmp_path / "out"), "2025-06-16"
    schema = "id bigint"
    for i in range(25):
        spark.range(i * 40, i * 40 + 40, 1, 20).write.parquet(f"{target}/day={day}/batch={i}")
    runs.land_batch(spark.range(5).withColumn("day", F.lit("2025-06-17")), target, 25)
    files = lambda: [p for p in (tmp_path / "out" / f"day={day}").rglob("*.parquet")]
    whole = lambda: sorted(r.id for r in runs.read_landed(spark, target, schema, [day]).collect())
    assert len(files()) == 500 and whole() == list(range(1000))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:  # written, but nothing deleted yet
        patch.setattr(folders, "forget", killed)
        with pytest.raises(KeyboardInterrupt):
            runs.compact_days(spark, target, schema, "2025-06-17")
    assert whole() == list(range(1000))
    (tmp_path / "out" / f"day={day}" / "upto=24" / "_SUCCESS").unlink()  # not even written to its end
    assert whole() == list(range(1000))
    assert runs.compact_days(spark, target, schema, "2025-06-17") == {day: 24}
    assert len(files()) == 1 and whole() == list(range(1000))
    assert runs.read_landed(spark, target, schema).count() == 1005


def test_a_result_table_of_many_batches_reads_few_folders(spark, tmp_path):
    texts = {f"{i:03}.txt": [line("apiCreatorTenantDomain=carbon.super,", f"2025-06-16T00:00:{i % 7:02}Z")] for i in range(40)}
    folder = write_files(tmp_path / "in", texts)
    lines = read_lines(spark, folder, stream=True, files_per_batch=1)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        counts = stream_hits.stream_hits(lines, "national", cleanse=False, delay="30 days")
        return rows(runs.run_to_table(counts, out, cp, ["second"], fold_after=5))

    expected = rows(reports.hits(read_lines(spark, folder), "national", cleanse=False))
    assert run() == expected
    assert len([p for p in (tmp_path / "out").iterdir() if "=" in p.name]) <= 6
    last = sorted((int(p.name) for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit()))[-1]
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    assert run() == expected


def test_late_rows_fail_a_stream_and_no_input_gives_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(delay, folder):
        stream = read_lines(spark, str(tmp_path / "in"), stream=True, files_per_batch=1)
        counts = stream_hits.stream_hits(stream, "national", cleanse=False, delay=delay)
        return runs.run_to_table(counts, str(tmp_path / folder / "out"), str(tmp_path / folder / "cp"), ["second"])

    assert run("10 minutes", "none").collect() == []
    for i, day in enumerate(("18", "17", "16")):  # newest first
        text = line("apiCreatorTenantDomain=carbon.super,", f"2025-06-{day}T00:00:00Z")
        (tmp_path / "in" / f"{i}.txt").write_text(text + "\n")
        os.utime(tmp_path / "in" / f"{i}.txt", (1_000_000 + i, 1_000_000 + i))
    with pytest.raises(runs.LateRows):
        run("10 minutes", "short")
    assert run("30 days", "long").count() == 3


def test_late_rows_of_forgotten_batches_fail_a_stream_too(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, day in enumerate(("18", "18", "16", "18", "18", "18", "18")):
        (tmp_path / "in" / f"{i}.txt").write_text(line(f"x{i}", f"2025-06-{day}T00:00:0{i}Z") + "\n")
        os.utime(tmp_path / "in" / f"{i}.txt", (1_000_000 + i, 1_000_000 + i))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")  # as 100 in a run of many batches
    try:
        stream = decode_lines(read_lines(spark, str(tmp_path / "in"), stream=True, files_per_batch=1))
        once = stream_hits.with_event_time(stream, "10 minutes").dropDuplicatesWithinWatermark(["time", "log"]).select("time", "log")
        with pytest.raises(runs.LateRows):
            runs.run_to_files(once, str(tmp_path / "out"), str(tmp_path / "cp"))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_two_pulls_of_one_day_and_one_again_lose_nothing(spark, lines, tmp_path):
    records = [decode_lines(lines(call(api=a), time=t)).drop("id") for a, t in (
        ("am", "2025-06-16T08:00:00Z"), ("pm", "2025-06-16T15:00:00Z"), ("late", "2025-06-17T00:10:00+07:00"), ("odd", "soon"))]
    for land, folder in ((ingest.land_pulled_events, "events"), (ingest.land_pulled_records, "text")):
        for piece, part in (("1", records[0].union(records[2])), ("2", records[1].union(records[3])), ("1", records[0].union(records[2]))):
            land(part, str(tmp_path / folder), piece)
    events = tables.read_events(spark, str(tmp_path / "events"))
    assert sorted(r.apiName for r in events.collect()) == ["am", "late", "pm"]
    text = read_lines(spark, str(tmp_path / "text"))
    assert sorted(r.file_stem for r in text.collect()) == ["logs_2025-06-16", "logs_2025-06-16", "logs_2025-06-17", "logs_unknown"]


def test_csv_columns_are_found_by_name_or_the_read_fails(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text('tipe_instansi,nama_instansi,extra,domain,akun_nasional,ord\nKota,"Dinas ""X"", Kota",e,d,a,3\n')
    row = tables.read_mapping(spark, str(path)).first()
    assert row.asDict() == {
        "ord": 3, "akun_nasional": "a", "domain": "d", "nama_instansi": 'Dinas "X", Kota', "tipe_instansi": "Kota", "extra": "e"}
    path.write_text("ord,domain\n1,d\n")
    with pytest.raises(ValueError, match="akun_nasional"):
        tables.read_mapping(spark, str(path))
    report = spark.createDataFrame([("s", 1)], "second string, hits bigint")
    sinks.write_report(report, str(tmp_path / "hits"), ["second"], sinks.REPORT_HEADERS)
    assert spark.read.option("header", True).csv(str(tmp_path / "hits")).columns == ["Timestamp", "Hits"]


def test_bad_extracts_are_named_or_fail(spark, tmp_path):
    good, bad, gone = (str(tmp_path / n) for n in ("good.csv", "bad.csv", "gone.csv"))
    header = "application_name,log_timestamp,api_name,api_creator,application_owner"
    (tmp_path / "good.csv").write_text(f"{header}\napp,2025-06-16 00:00:00,a,c,o\n")
    (tmp_path / "bad.csv").write_text("x,y\n1,2\n")
    frame, left_out = tables.read_extract_keys_of(spark, [good, bad, gone], skip_bad=True)
    assert [tuple(r) for r in frame.collect()] == [("2025-06-16 00:00:00", "a", "c", "o", "app")]
    assert set(left_out) == {bad, gone}
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_extract_keys_of(spark, [good, bad])
    with pytest.raises(ValueError, match="no such file"):
        tables.read_extract_keys_of(spark, [good, gone])
    with pytest.raises(ValueError, match="no extract can be read"):
        tables.read_extract_keys_of(spark, [bad, gone], skip_bad=True)


def test_many_extracts_in_different_orders_are_read_by_one_plan(spark, tmp_path):
    orders = [
        ["log_timestamp", "api_name", "api_creator", "application_owner", "application_name"],
        ["application_name", "note", "api_creator", "api_name", "log_timestamp", "application_owner"],
        ["note", "note", "application_owner", "log_timestamp", "api_name", "api_creator", "application_name"],
    ]
    paths = []
    for i in range(300):
        columns = orders[i % 3]
        path = tmp_path / f"day {i}.csv"
        cells = ['"a ""note"", x"' if c == "note" else f"{c} {i}" for c in columns]
        path.write_text(",".join(columns) + "\n" + ",".join(cells) + "\n")
        paths.append(str(path))
    (tmp_path / "bad one.csv").write_text("x,y\n1,2\n")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("extracts", "extracts")
    frame, left_out = tables.read_extract_keys_of(spark, [*paths, str(tmp_path / "bad one.csv")], skip_bad=True)
    jobs = len(status.getJobIdsForGroup("extracts"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 10  # the headers, and one listing per order
    assert set(left_out) == {str(tmp_path / "bad one.csv")}
    assert rows(frame) == sorted(tuple(f"{c} {i}" for c in orders[0]) for i in range(300))
    assert str(frame._jdf.queryExecution().optimizedPlan()).count("Relation") == 3


def test_a_catalog_that_is_read_can_be_replaced(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "catalog")
    with pytest.raises(ValueError, match="no complete version"):
        tables.read_catalog_version(spark, target)
    first = spark.createDataFrame([("p", "c", "a", "1", "t.go.id", "PUBLISHED", None, None)], CATALOG_DDL)
    assert sinks.write_version(first, target) == 1
    grown = tables.read_catalog_version(spark, target).withColumn("occurrence", F.lit(7).cast("bigint"))
    assert sinks.write_version(grown, target) == 2
    expected = rows(tables.read_catalog_version(spark, target))
    assert expected[0][-1] == 7
    broken = tables.read_catalog_version(spark, target).withColumn("occurrence", F.raise_error(F.lit("died")).cast("bigint"))
    with pytest.raises(Exception, match="died"):
        sinks.write_version(broken, target)
    # what a process that is killed leaves: files, but no end
    (tmp_path / "catalog" / "version=4").mkdir()
    (tmp_path / "catalog" / "version=4" / "part-0.parquet").write_text("half")
    assert rows(tables.read_catalog_version(spark, target)) == expected
    assert sinks.write_version(tables.read_catalog_version(spark, target), target) == 5
    assert rows(tables.read_catalog_version(spark, target)) == expected
    assert not (tmp_path / "catalog" / "version=1").exists() and (tmp_path / "catalog" / "version=2").exists()


def test_undated_records_are_counted_and_stay_out_of_dated_reads(spark, lines, tmp_path):
    texts = [call(api="in"), call(api="late"), call(api="odd")]
    records = [decode_lines(lines(t, time=at)).drop("id") for t, at in zip(texts, ("2025-06-16T08:00:00Z", "2025-06-18T00:00:00Z", "soon"))]
    source = str(tmp_path / "text")
    ingest.land_pulled_records(records[0].union(records[1]).union(records[2]), source, "1")
    counts = ingest.ingest_typed(spark, source, str(tmp_path / "events"), "2025-06-16", "2025-06-17")
    assert counts == {"lines": 1, "events": 1, "undated": 1}
    assert [r.apiName for r in tables.read_events(spark, str(tmp_path / "events")).collect()] == ["in"]
    assert ingest.ingest_typed(spark, source, str(tmp_path / "all")) == {"lines": 2, "events": 2, "undated": 1}
    assert read_day_lines(spark, source, first="2025-06-17").count() == 1
    assert sorted(r.file_date for r in read_lines(spark, source, first="2025-06-16").collect()) == ["2025-06-16", "2025-06-18"]
    assert read_lines(spark, source, last="2025-06-16").count() == 1
    assert read_lines(spark, source).count() == 3


def test_landed_lines_keep_every_key(spark, tmp_path):
    raw = ['{"log": "x",\n "pod": "p1", "time": "2025-06-16T08:00:00Z", "stream": "s", "deep": {"a": [1]}}', '{"log":"y","time":"soon"}']
    records = decode_lines(spark.createDataFrame([(r, r) for r in raw], "line string, value string"))
    ingest.land_pulled_records(records, str(tmp_path / "out"), "1")
    got = spark.read.text(str(tmp_path / "out"))
    assert sorted((json.loads(r.value) for r in got.collect()), key=str) == sorted(map(json.loads, raw), key=str)


def test_day_columns_name_the_unknown_day_and_have_a_limit(spark, lines, mapping):
    frame = lines(call(), call()).withColumn("file_stem", F.when(F.col("id") == 0, "logs_x"))
    wide = reports.recap_daily(frame, mapping(("a", "b", "c", "d")), "internal", cleanse=False)
    assert {"logs_x", "unknown"} <= set(wide.columns)
    with pytest.raises(ValueError, match="more than 1"):
        usage.distinct_texts(frame.select(F.lit("a").alias("x")).union(frame.select(F.lit("b"))), "x", most=1)


@pytest.mark.parametrize("text,good", [("2025-06-16", True), ("2025-06-16T01:02:03Z", True), ("2025-06-16Tjunk", False), ("2025-13-01", False), ("", False)])
def test_only_days_are_dates(spark, text, good):
    frame = spark.createDataFrame([(text,)], "x string")
    assert frame.select(reports.is_date("x")).first()[0] is good


def test_stream_ingest_takes_each_file_once(spark, day_files, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):
        lines = read_day_lines(spark, day_files, stream=True)
        query = runs.ingest_stream(ingest.typed_day_lines(lines), out, checkpoint)
        query.awaitTermination()
    assert tables.read_events(spark, out).count() == 4


def test_both_recaps_from_one_scan_equal_the_two_single_ones(spark):
    lines, mapping = fx.lines(spark, SF), fx.mapping(spark, SF)
    both = reports.recap_both_levels(lines, mapping, cleanse=True)
    for level, got in zip(("national", "internal"), both):
        assert rows(got) == rows(reports.recap(lines, mapping, level, cleanse=True))


# --- plans ----------------------------------------------------------------------------


def executed_scans(frame):
    """Text file scans that ran for ``frame``, by the rows they report."""
    frame.collect()
    counts = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ReusedExchangeExec":
            return
        if kind == "FileSourceScanExec" and "text" in node.toString():
            counts.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return [c for c in counts if c]


@pytest.mark.parametrize("name", ["extract", "all_dataset", "recap", "recap_daily_long", "hits_summary", "usage_by_date", "accumulate"])
def test_a_report_scans_the_log_once(spark, tmp_path, name):
    fx.lines(spark, SF).select("value").write.text(str(tmp_path / "log"))
    lines, mapping = read_lines(spark, str(tmp_path / "log")), fx.mapping(spark, SF)
    frame = {
        "extract": lambda: reports.extract(lines),
        "all_dataset": lambda: reports.all_dataset(lines, "internal", cleanse=True),
        "recap": lambda: reports.recap(lines, mapping, "internal", cleanse=True),
        "recap_daily_long": lambda: reports.recap_daily_long(lines, "internal", cleanse=True),
        "hits_summary": lambda: reports.hits_summary(lines, "national", cleanse=False),
        "usage_by_date": lambda: reports.usage_by_date(reports.extract(lines), mapping),
        "accumulate": lambda: usage.accumulate(reports.recap(lines, mapping, "internal", cleanse=True)),
    }[name]()
    assert executed_scans(frame) == [spark.read.text(str(tmp_path / "log")).count()]


def test_a_batch_is_set_aside_once_however_many_days_it_has(spark, tmp_path, monkeypatch):
    folder = write_files(tmp_path / "in", {"a.txt": [line(f"x{i}", f"2025-06-1{i}T00:00:00Z") for i in range(4)] + [line("x0", "2025-06-10T00:00:00Z")]})
    made = []
    monkeypatch.setattr(runs, "settle", lambda df: made.append(settle(df)) or made[-1])
    land(spark, folder, tmp_path)
    assert len(made) == 1
    assert len(landed(spark, tmp_path)) == 4


def test_what_a_batch_that_died_has_left_is_replaced(spark, tmp_path):
    target, rows = str(tmp_path / "out"), spark.range(3).withColumn("day", F.lit("2025-06-17"))
    spark.range(9).write.parquet(f"{target}/day=2025-06-17/batch=2")
    (tmp_path / "out" / "day=2025-06-17" / "batch=2" / "_SUCCESS").unlink()
    assert runs.read_landed(spark, target, "id long").count() == 0
    for _ in range(2):
        runs.land_batch(rows, target, 2)
        assert runs.read_landed(spark, target, "id long").count() == 3


def test_a_large_day_is_compacted_by_many_tasks(spark, tmp_path, monkeypatch):
    target, size = str(tmp_path / "out"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    runs.land_batch(spark.range(0, 200000, 1, 8).withColumn("day", F.lit("2025-06-17")), target, 0)
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        assert runs.compact_days(spark, target, "id long", "2025-06-18", least=1) == {"2025-06-17": 0}
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "out" / "day=2025-06-17" / "upto=0").glob("*.parquet"))) > 1
    assert runs.read_landed(spark, target, "id long").distinct().count() == 200000
