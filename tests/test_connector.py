import ast
import json
import uuid

import pytest

from pyspark.sql import functions as F

from pintulog.plans.pull import catch_up, pull_entries, pull_range, pull_stream
from pintulog.sources.range_pull import HOUR, NANOS, StoreLimit, narrowed, pull, range_source, steps, to_nanos, volume_steps
from pintulog.streaming import runs

START = to_nanos("2025-06-16T00:00:00Z")


def plain(pulled):
    """Entries without labels."""
    return sorted((at, line) for at, line, _ in pulled)


def entry(at, number):
    line = json.dumps({"log": f"call {number}", "time": f"t{at}", "stream": "stdout"})
    return at, line


def store(entries, calls=None):
    """A page source with the store's contract over fixed entries in two series."""

    def fetch(query, start, end, limit):
        if calls is not None:
            calls.append((start, end, limit))
        hit = sorted((e for e in entries if start <= e[0] < end), key=lambda e: e[0])[:limit]
        series = [[], []]
        for i, (at, line) in enumerate(hit):
            series[i % 2].append([str(at), line])
        return json.dumps({"data": {"result": [{"stream": {}, "values": s} for s in series]}})

    return fetch


def test_times_keep_nanoseconds_and_zones():
    assert to_nanos("1970-01-01T00:00:01.000000005Z") == 1_000_000_005
    assert to_nanos("1970-01-01T07:00:00+07:00") == 0
    assert to_nanos("2025-06-30T23:59:59.999999999Z") % 1_000_000_000 == 999_999_999


def test_steps_are_half_open_and_cover_the_range():
    cut = steps(START, START + 2 * HOUR + 5, HOUR)
    assert [(s.start, s.end) for s in cut] == [
        (START, START + HOUR),
        (START + HOUR, START + 2 * HOUR),
        (START + 2 * HOUR, START + 2 * HOUR + 5),
    ]


def test_boundary_entries_are_delivered_once():
    entries = [entry(START + i // 3, i) for i in range(20)]
    calls = []
    got = plain(pull(store(entries, calls), "q", START, START + HOUR, 4))
    assert got == sorted(entries)
    assert len(calls) > 4


def test_equal_lines_at_one_time_are_all_kept():
    entries = [entry(START, 1)] * 3 + [entry(START + 1, 2)] * 2
    assert plain(pull(store(entries), "q", START, START + HOUR, 4)) == sorted(entries)


def test_more_entries_at_one_time_than_a_page_holds():
    entries = [entry(START + 7, i) for i in range(23)] + [entry(START + 8, 99)]
    assert plain(pull(store(entries), "q", START, START + HOUR, 5)) == sorted(entries)


def clamped(entries, most):
    """A store that returns at most ``most`` entries, whatever is asked for."""
    plain = store(entries)
    return lambda query, start, end, limit: plain(query, start, end, min(limit, most))


def test_a_store_with_small_pages_loses_nothing():
    entries = [entry(START + i // 5, i) for i in range(200)]
    assert plain(pull(clamped(entries, 20), "q", START, START + HOUR, 500)) == sorted(entries)


def test_a_time_with_more_entries_than_the_store_returns_fails():
    entries = [entry(START + 7, i) for i in range(50)] + [entry(START + 9, 99)]
    with pytest.raises(StoreLimit):
        list(pull(clamped(entries, 20), "q", START, START + HOUR, 20))
    with pytest.raises(StoreLimit):
        list(pull(clamped(entries[:50], 20), "q", START, START + HOUR, 20))


@pytest.mark.parametrize("before", [0, 1, 7, 5200])
@pytest.mark.parametrize("limit, most, at_last", [(500, 5000, 8000), (500, 50, 80), (5, 5, 8), (5, 5, 5), (5, 5, 4), (500, 500, 499), (500, 500, 501), (3, 2, 2), (10, 5000, 300)])
def test_a_cut_last_time_is_delivered_whole_or_fails(limit, most, at_last, before):
    """Pages below, at and above the store's limit, with nothing after the time that may be cut."""
    entries = [entry(START + i // 2, i) for i in range(before)] + [entry(START + HOUR - 1, 10_000 + i) for i in range(at_last)]
    cut = at_last >= most
    try:
        got = plain(pull(clamped(entries, most), "q", START, START + HOUR, limit))
    except StoreLimit:
        # it may fail where the store has never returned more at once than lies at that time
        assert cut or before <= 1
    else:
        assert got == sorted(entries)
    # who knows the store's limit gets everything that can be had
    if not cut:
        assert plain(pull(clamped(entries, most), "q", START, START + HOUR, limit, store_page=most)) == sorted(entries)
    else:
        with pytest.raises(StoreLimit):
            list(pull(clamped(entries, most), "q", START, START + HOUR, limit, store_page=most))


def test_a_longer_page_elsewhere_proves_that_a_time_is_whole():
    entries = [entry(START - 20 * HOUR + i, i) for i in range(9)] + [entry(START + 5, 100 + i) for i in range(4)]
    assert plain(pull(clamped(entries, 6), "q", START, START + HOUR, 500)) == sorted(entries[9:])
    assert plain(pull(clamped(entries[9:10], 6), "q", START, START + HOUR, 500)) == entries[9:10]


def counting(entries, calls=None):
    def volume(query, start, end, bins):
        counts = [0] * bins
        for at, _ in entries:
            if start <= at < end:
                counts[next(k for k in range(bins) if at < start + (end - start) * (k + 1) // bins)] += 1
        if calls is not None:
            calls.append((start, end, bins))
        return counts

    return volume


def test_slices_follow_the_volume():
    dense = [entry(START + 7 * HOUR + (i * 7919) % (60 * NANOS), i) for i in range(1800)]
    entries = dense + [entry(START + i * 6 * 60 * NANOS, 5000 + i) for i in range(200)]
    calls = []
    cut = volume_steps(counting(entries, calls), "q", START, START + 24 * HOUR, 100)
    assert cut[0].start == START and cut[-1].end == START + 24 * HOUR
    assert all(a.end == b.start for a, b in zip(cut, cut[1:]))
    held = sorted(sum(s.start <= at < s.end for at, _ in entries) for s in cut)
    assert max(held) <= 2 * held[len(held) // 2]
    assert len(calls) < 40
    assert volume_steps(counting([]), "q", START, START + HOUR, 10)[0].end == START + HOUR
    assert volume_steps(counting([]), "q", START, START, 10) == []
    # one time with too many entries stays one slice
    heap = [entry(START + 5, i) for i in range(50)]
    assert [(s.start, s.end) for s in volume_steps(counting(heap), "q", START, START + 8, 10) if s.start <= START + 5 < s.end] == [(START + 5, START + 6)]


def test_filters_reach_the_store(spark, tmp_path):
    """Every call of the store leaves a file, since it happens in a worker."""
    entries = [entry(START + i * 60 * NANOS, i) for i in range(600)]

    def fetch(query, start, end, limit):
        (tmp_path / uuid.uuid4().hex).write_text(f"{query}\n{start}\n{end}")
        hit = [e for e in entries if start <= e[0] < end][:limit]
        series = [(c, [[str(at), line] for at, line in hit if "ab"[at // (60 * NANOS) % 2] == c]) for c in "ab"]
        return json.dumps({"data": {"result": [{"stream": {"container": c, "other": "x"}, "values": v} for c, v in series]}})

    def calls():
        found = [p.read_text().split("\n") for p in tmp_path.iterdir()]
        for p in tmp_path.iterdir():
            p.unlink()
        return found

    frame = pull_entries(
        spark, fetch, "2025-06-16T00:00:00Z", "2025-06-16T10:00:00Z", '{app="g}w"} |~ "x"', limit=20, step_hours=1, labels=("container",)
    )
    assert frame.columns == ["store_time", "line", "container"]
    assert frame.count() == 600
    whole = calls()
    low, high = START + 3 * HOUR, START + 4 * HOUR + 1
    some = frame.where((F.col("store_time") >= low) & (F.col("store_time") < high) & (F.col("container") == "a") & F.col("line").contains("call"))
    got = some.collect()
    assert sorted(r.store_time for r in got) == [at for at, _ in entries if low <= at < high and at // (60 * NANOS) % 2 == 0]
    pushed = calls()
    assert 0 < len(pushed) < len(whole) / 4
    assert all(low <= int(start) and int(end) <= high + 1 for _, start, end in pushed if int(end) - int(start) <= HOUR)
    assert {query for query, _, _ in pushed} == {'{app="g}w", container="a"} |~ "x" |= "call"'}
    assert sorted((r.store_time, r.line) for r in got) == sorted((r.store_time, r.line) for r in frame.collect() if low <= r.store_time < high and r.container == "a")


def test_matchers_go_into_the_selector():
    assert narrowed("{}", {"a": 'x"y'}, []) == '{a="x\\"y"}'
    assert narrowed('{a=`}`, b="\\"}"} |= "z"', {"c": "d"}, ["e"]) == '{a=`}`, b="\\"}", c="d"} |= "z" |= "e"'
    assert narrowed("plain", {"a": "b"}, ["c"]) == "plain" and narrowed('{a="', {"a": "b"}, []) == '{a="'


def test_a_backlog_comes_in_bounded_batches_and_a_restart_repeats_nothing(spark, tmp_path):
    entries = [entry(START + i * 36 * HOUR, i) for i in range(240)]  # about a year

    def start(until):
        source = range_source(store(entries), f"log_range_{until}", lambda: START + until * 24 * HOUR)
        stream = pull_stream(spark, source, "2025-06-16T00:00:00Z", "q", stepHours="24", stepsPerBatch="50", lagSeconds="0")
        writer = stream.select("log").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        return writer.option("checkpointLocation", str(tmp_path / "cp")).start()

    def spans(progress):
        found = [[START if s[k] in (None, "None") else ast.literal_eval(s[k])["next"] for k in ("startOffset", "endOffset")] for p in progress for s in p["sources"]]
        return [(high - low) // (24 * HOUR) for low, high in found if high > low]

    assert spans(catch_up(lambda: start(120))) == [50, 50, 20]
    assert spans(catch_up(lambda: start(360))) == [50, 50, 50, 50, 40]
    assert spans(catch_up(lambda: start(360))) == []
    got = spark.read.schema("log string").parquet(str(tmp_path / "out"))
    assert sorted(r.log for r in got.collect()) == sorted(f"call {i}" for i in range(240))


def test_a_pull_that_starts_anew_lands_nothing_twice(spark, tmp_path):
    times = ["2025-06-16T00:00:00Z", "soon", "2025-06-17T05:00:00Z"]
    entries = [(START + i * NANOS, json.dumps({"log": f"call {i}", "time": times[i % 3], "stream": "stdout"})) for i in range(30)]
    source = range_source(store(entries), "log_range_anew", lambda: START + HOUR)
    for checkpoint in ("first", "second"):  # the second knows nothing of the first but what has landed
        stream = pull_stream(spark, source, "2025-06-16T00:00:00Z", "q", lagSeconds="0").select("time", "log")
        # another checkpoint begins with batch 0 again, so it lands beside the first one
        runs.land_once(stream, str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()
        assert runs.read_landed(spark, str(tmp_path / "out"), "log string").count() == 30


def test_spark_pull_equals_the_store(spark):
    entries = [entry(START + (i * 97) * 10**9 // 2, i) for i in range(150)]
    gap = [e for e in entries if not START + HOUR <= e[0] < START + 2 * HOUR]
    gap.append((START + 3, "no json"))
    frame = pull_range(
        spark, store(gap), "2025-06-16T00:00:00Z", "2025-06-16T04:00:00Z", "q", limit=7, step_hours=1
    )
    assert frame.rdd.getNumPartitions() == 4
    got = sorted(r.log for r in frame.collect())
    assert got == sorted(f"call {i}" for i in range(150) if entries[i] in gap)


def test_a_failing_page_fails_the_pull_instead_of_leaving_a_gap(spark):
    def broken(query, start, end, limit):
        raise OSError("store is down")

    frame = pull_range(spark, broken, "2025-06-16T00:00:00Z", "2025-06-16T01:00:00Z", "q")
    with pytest.raises(Exception, match="store is down"):
        frame.collect()


def test_stream_pull_delivers_everything_once(spark, tmp_path):
    entries = [entry(START + i * 10**9, i) for i in range(50)]
    fetch, end = store(entries), START + 2 * HOUR
    source = range_source(fetch, "log_range_stream", lambda: end)

    def run():
        stream = pull_stream(spark, source, "2025-06-16T00:00:00Z", "q", limit="8", lagSeconds="0")
        query = (
            stream.writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(processingTime="0 seconds")
            .start()
        )
        query.processAllAvailable()
        query.stop()

    run()
    run()
    got = spark.read.schema("log string").parquet(str(tmp_path / "out"))
    assert sorted(r.log for r in got.collect()) == sorted(f"call {i}" for i in range(50))
