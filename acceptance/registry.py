"""Every registered query, by its inventory key: (session, table folder) -> DataFrame."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acceptance import fixtures as fx
from pintulog import sinks
from pintulog.operators import counters, filters, lookup, parsing, upsert, usage
from pintulog.plans import catalog as catalog_plan
from pintulog.plans import ingest, institutions, pull, reports
from pintulog.schemas import EVENT_DDL
from pintulog.shared import shared_folder
from pintulog.sources import envelope, tables
from pintulog.sources.lines import decode_lines, read_day_lines, read_lines, stem_date
from pintulog.streaming import hits as stream_hits
from pintulog.streaming import runs

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _text(ts: str):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(ts)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_lines(fx.lines(spark, sf_dir))


# --- scans and filters --------------------------------------------------------------


@query
def scan_log_lines(spark, sf_dir):
    records = _records(spark, sf_dir)
    return records.select(
        "event_id", "file_stem", stem_date().alias("file_date"), "log", "time", "stream"
    )


@query
def scan_scoped(spark, sf_dir):
    records = reports.scoped_records(fx.lines(spark, sf_dir), "national", cleanse=True)
    return records.select("event_id", "time", "log", "file_stem")


@query
def file_date_filter(spark, sf_dir):
    dated = _records(spark, sf_dir).withColumn("file_date", stem_date())
    kept = filters.file_dates(dated, "2025-06-17", "2025-06-19")
    return kept.select("event_id", "file_stem", "file_date", "time")


@query
def tenant_scope(spark, sf_dir):
    records = _records(spark, sf_dir)
    return filters.with_scope(records).where("level is not null").select("event_id", "level")


@query
def cleansed_lines(spark, sf_dir):
    return filters.cleansed(_records(spark, sf_dir)).select("event_id", "log")


@query
def line_quality(spark, sf_dir):
    return counters.line_quality(fx.lines(spark, sf_dir))


@query
def label_line_filter(spark, sf_dir):
    container = F.when(F.col("event_id") % 20 == 0, "other").otherwise("gateway")
    records = _records(spark, sf_dir).withColumn("container", container)
    kept = filters.labelled_lines(
        records, {"container": "gateway"}, "Metric Name: apim:response"
    )
    return kept.select("event_id", "container", "log")


@query
def time_range(spark, sf_dir):
    kept = filters.time_range(
        _records(spark, sf_dir), "2025-06-17T00:02:00", "2025-06-19T00:05:30"
    )
    return kept.select("event_id", "time")


@query
def bad_dates(spark, sf_dir):
    stamp = (
        F.when(F.col("event_id") % 211 == 0, F.concat(F.lit(" junk"), F.col("event_id") % 10))
        .when(F.col("event_id") % 223 == 0, F.lit("2025-13-45 00:00:00"))
        .otherwise(F.replace(F.col("time"), F.lit("T"), F.lit(" ")))
    )
    return reports.bad_dates(_records(spark, sf_dir).select(stamp.alias("log_timestamp")))


@query
def envelope_records(spark, sf_dir):
    records = envelope.flatten_pages(fx.pages(spark, sf_dir))
    return records.select(
        "event_id", F.col("labels")["container"].alias("container"), "store_time", "log", "time",
        "stream",
    )


# --- parsing ------------------------------------------------------------------------


@query
def parse_fields_13(spark, sf_dir):
    return parsing.analysis_fields(_records(spark, sf_dir), "event_id")


@query
def parse_fields_29(spark, sf_dir):
    return parsing.extract_text_fields(_records(spark, sf_dir), "event_id")


@query
def flat_extract(spark, sf_dir):
    rows = reports.extract(fx.lines(spark, sf_dir), "event_id")
    others = [c for c in rows.columns if not c.endswith("timestamp")]
    return rows.select(*others, _text("log_timestamp"), _text("request_timestamp"))


@query
def metric_map(spark, sf_dir):
    maps = parsing.metric_maps(_records(spark, sf_dir), "event_id")
    entries = F.transform(
        F.array_sort(F.map_entries("metrics")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return maps.select("event_id", F.array_join(entries, "|").alias("metrics"))


@query
def metric_map_balanced(spark, sf_dir):
    """As ``metric_map``, a block ending at the brace that closes it."""
    maps = parsing.metric_maps(_records(spark, sf_dir), "event_id", balanced=True)
    entries = F.transform(
        F.array_sort(F.map_entries("metrics")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return maps.select("event_id", F.array_join(entries, "|").alias("metrics"))


@query
def metric_values_long(spark, sf_dir):
    return parsing.metric_values_long(_records(spark, sf_dir), "event_id")


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = decode_lines(fx.lines(spark, sf_dir), require_time=False)
    return parsing.typed_events(records, "event_id", "file_stem")


@query
def typed_events(spark, sf_dir):
    events = _typed(spark, sf_dir).drop("file_stem")
    others = [c for c in events.columns if c not in ("time", "requestTimestamp")]
    return events.select(*others, _text("time"), _text("requestTimestamp"))


# --- lookups ------------------------------------------------------------------------


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = parsing.analysis_fields(_records(spark, sf_dir))
    return usage.count_calls(calls, "apiCreator", "applicationOwner")


def _account_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _accounts(spark, sf_dir)
    return lookup.keys_of(table, ["apiCreator", "applicationOwner"], "occurrence")


@query
def lookup_first_substring(spark, sf_dir):
    table = _accounts(spark, sf_dir)
    keys = lookup.keys_of(table, ["apiCreator", "applicationOwner"], "occurrence")
    mapping = fx.mapping(spark, sf_dir)
    by_account = lookup.substring_lookup(keys, mapping, "akun_nasional")
    by_domain = lookup.substring_lookup(keys, mapping, "domain")
    table = lookup.attach(table, "apiCreator", by_account, "creator_national")
    table = lookup.attach(table, "apiCreator", by_domain, "creator_internal")
    return lookup.attach(table, "applicationOwner", by_account, "owner_national")


@query
def owner_lookup(spark, sf_dir):
    keys = _account_keys(spark, sf_dir)
    hits = lookup.owner_lookup(keys, fx.mapping(spark, sf_dir))
    return lookup.attach(keys, "key", hits, "nama_instansi", default=None)


@query
def requester_lookup(spark, sf_dir):
    keys = _account_keys(spark, sf_dir)
    hits = lookup.requester_lookup(keys, fx.mapping(spark, sf_dir))
    return lookup.attach(keys, "key", hits, "nama_instansi")


@query
def map_institution(spark, sf_dir):
    return institutions.map_institution(fx.api_list(spark, sf_dir), fx.mapping(spark, sf_dir))


# --- reports ------------------------------------------------------------------------


@query
def all_dataset(spark, sf_dir):
    return reports.all_dataset(fx.lines(spark, sf_dir), "internal", cleanse=True)


@query
def recap_aggregated(spark, sf_dir):
    return reports.recap(
        fx.lines(spark, sf_dir), fx.mapping(spark, sf_dir), "internal", cleanse=True
    )


@query
def recap_national(spark, sf_dir):
    return reports.recap(
        fx.lines(spark, sf_dir), fx.mapping(spark, sf_dir), "national", cleanse=False
    )


@query
def recap_daily_long(spark, sf_dir):
    return reports.recap_daily_long(fx.lines(spark, sf_dir), "internal", cleanse=True)


@query
def recap_daily_pivot(spark, sf_dir):
    return reports.recap_daily(
        fx.lines(spark, sf_dir), fx.mapping(spark, sf_dir), "internal", cleanse=True
    )


@query
def hits_per_second(spark, sf_dir):
    return reports.hits(fx.lines(spark, sf_dir), "internal", cleanse=False)


@query
def hits_summary(spark, sf_dir):
    return reports.hits_summary(fx.lines(spark, sf_dir), "national", cleanse=False)


@query
def usage_by_date(spark, sf_dir):
    rows = reports.extract(fx.lines(spark, sf_dir))
    return reports.usage_by_date(rows, fx.mapping(spark, sf_dir))


def _grouped_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, mapping = fx.lines(spark, sf_dir), fx.mapping(spark, sf_dir)
    return usage.accumulate(reports.recap(lines, mapping, "internal", cleanse=True))


@query
def accumulate_usage(spark, sf_dir):
    return _grouped_usage(spark, sf_dir)


# --- catalog ------------------------------------------------------------------------


@query
def catalog_update(spark, sf_dir):
    per_key = catalog_plan.catalog_usage(_grouped_usage(spark, sf_dir))
    return upsert.catalog_update(fx.catalog(spark, sf_dir), per_key)


@query
def catalog_insert(spark, sf_dir):
    per_key = catalog_plan.catalog_usage(_grouped_usage(spark, sf_dir))
    return upsert.catalog_insert(fx.catalog(spark, sf_dir), per_key)


@query
def catalog_upsert(spark, sf_dir):
    lines, mapping = fx.lines(spark, sf_dir), fx.mapping(spark, sf_dir)
    catalog = fx.catalog(spark, sf_dir)
    return catalog_plan.refresh_from_lines(catalog, lines, mapping, cleanse=True)


@query
def catalog_written_back(spark, sf_dir):
    """A versioned catalog after two refreshes that read and replace it."""
    target = shared_folder(spark)
    sinks.write_version(fx.catalog(spark, sf_dir), target)
    for _ in range(2):
        lines, mapping = fx.lines(spark, sf_dir), fx.mapping(spark, sf_dir)
        catalog_plan.write_back(spark, target, lines, mapping, cleanse=True)
    return tables.read_catalog_version(spark, target)


@query
def catalog_without_counts(spark, sf_dir):
    """A catalog before its first refresh, as CSV without the column of counts."""
    path = f"{shared_folder(spark)}/catalog.csv"
    sinks.write_report(fx.catalog(spark, sf_dir).drop("occurrence"), path)
    return upsert.with_occurrence(tables.read_catalog(spark, path))


# --- landed tables: written to shared storage by Spark, then scanned -------------------


@query
def scan_text_files(spark, sf_dir):
    """Day text files between two dates, read back by file name."""
    folder = shared_folder(spark)
    days = fx.lines(spark, sf_dir).select(stem_date().alias("day"), "value")
    days.write.partitionBy("day").text(folder)
    records = decode_lines(read_lines(spark, folder, "2025-06-17", "2025-06-18"))
    return records.select("file_stem", "file_date", "log", "time", "stream")


@query
def scan_typed_events(spark, sf_dir):
    """Typed Parquet after a full write and a second write of some days only."""
    folder = shared_folder(spark)
    events = _typed(spark, sf_dir).drop("event_id")
    events = events.withColumn("day", stem_date().cast("date")).drop("file_stem")
    sinks.write_events(events, folder)
    sinks.write_events(events.where("day >= date'2025-06-19'"), folder, compact=True)
    landed = tables.read_events(spark, folder, "2025-06-17", "2025-06-19")
    return landed.select(
        F.col("day").cast("string").alias("day"), "apiName", "proxyResponseCode",
        "responseCacheHit", "backendLatency", "apiCreator", "userIp", _text("time"),
        _text("requestTimestamp"),
    )


@query
def scan_extract_csv(spark, sf_dir):
    """The five key columns of extract CSV files, one folder per source day."""
    folder = shared_folder(spark)
    rows = reports.extract(fx.lines(spark, sf_dir), "file_stem")
    # another column order, and a column of no use here, as other writers have it
    columns = [c for c in reversed(rows.columns) if c != "file_stem"]
    noted = F.concat(F.lit('a "note", with '), F.col("api_name")).alias("note")
    sinks.write_extract(rows.select(noted, *columns, "file_stem"), folder)
    return tables.read_extract_keys(spark, folder)


@query
def extract_undivided(spark, sf_dir):
    """An extract as one CSV dataset, read back by its keys, and some extracts at once."""
    folder = shared_folder(spark)
    rows = reports.extract(fx.lines(spark, sf_dir), "event_id")
    sinks.write_extract(rows.where("event_id % 2 = 0").drop("event_id"), f"{folder}/even", by=None)
    odd = rows.where("event_id % 2 = 1").drop("event_id")
    sinks.write_extract(odd.select(*reversed(odd.columns)), f"{folder}/odd", by=None)
    return tables.read_extract_keys_of(spark, [f"{folder}/even", f"{folder}/odd"])[0]


@query
def report_in_order(spark, sf_dir):
    """A report as CSV, with the place of each row in the files."""
    path = f"{shared_folder(spark)}/usage.csv"
    sinks.write_report(_grouped_usage(spark, sf_dir), path, order=usage.USAGE_KEYS)
    read = spark.read.option("header", "true").csv(path).select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("id"))
    place = F.row_number().over(Window.orderBy("file", "id"))
    return read.select(*usage.USAGE_KEYS, F.col("occurrence").cast("bigint").alias("occurrence"), place.alias("place"))


@query
def scan_mapping(spark, sf_dir):
    """A mapping as CSV in another column order, with quotes, commas and a further column."""
    path = f"{shared_folder(spark)}/mapping.csv"
    name = F.concat("nama_instansi", F.lit(' "Pusat", Kota')).alias("nama_instansi")
    kode = F.concat(F.lit("n"), "ord").alias("kode")
    rows = fx.mapping(spark, sf_dir).select(name, "tipe_instansi", kode, "domain", "akun_nasional", "ord")
    sinks.write_report(rows, path)
    return tables.read_mapping(spark, path)


@query
def scan_catalog(spark, sf_dir):
    """A catalog as CSV, its further column passed through."""
    path = f"{shared_folder(spark)}/catalog.csv"
    sinks.write_report(fx.catalog(spark, sf_dir), path)
    return tables.read_catalog(spark, path)


def _pulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as pulls deliver them, some with an unreadable time or past midnight."""
    time = F.when(F.col("event_id") % 157 == 0, "no time").when(F.col("event_id") % 163 == 0, "2025-06-21T00:00:01+07:00")
    return _records(spark, sf_dir).withColumn("time", time.otherwise(F.col("time")))


def _land(records: DataFrame, land, folder: str) -> None:
    """Two pulls that share their days, and the first of them once more."""
    morning = F.col("event_id") % 2 == 0
    land(records.where(morning), folder, "morning")
    land(records.where(~morning), folder, "afternoon")
    land(records.where(morning), folder, "morning")


@query
def land_pulled_events(spark, sf_dir):
    folder = shared_folder(spark)
    _land(_pulled(spark, sf_dir), ingest.land_pulled_events, folder)
    landed = spark.read.parquet(folder)
    morning = (F.col("slice") == "morning").alias("morning")
    return landed.select(F.col("day").cast("string").alias("day"), morning, "apiName", "userIp", _text("time"))


@query
def land_pulled_records(spark, sf_dir):
    folder = shared_folder(spark)
    pod = F.concat(F.lit("pod-"), F.col("event_id") % 3).alias("pod")
    line = F.to_json(F.struct("log", pod, "time", "stream"))
    _land(_pulled(spark, sf_dir).withColumn("line", line), ingest.land_pulled_records, folder)
    lines = read_lines(spark, folder).withColumn("pod", F.get_json_object("value", "$.pod"))
    return decode_lines(lines).select("file_date", "log", "time", "pod")


@query
def ingest_landed_records(spark, sf_dir):
    """Landed records of some days as typed events; what has no readable time stays out."""
    folder = shared_folder(spark)
    _land(_pulled(spark, sf_dir), ingest.land_pulled_records, f"{folder}/text")
    ingest.ingest_typed(spark, f"{folder}/text", f"{folder}/events", "2025-06-17", "2025-06-21")
    events = tables.read_events(spark, f"{folder}/events")
    return events.select(F.col("day").cast("string").alias("day"), "apiName", "userIp", _text("time"))


# --- pulls: a store over the same lines, its pages clamped ------------------------------


@query
def pull_range(spark, sf_dir):
    """All a store holds, up to its last entry."""
    folder = shared_folder(spark)
    fetch, volume = fx.log_store(spark, folder, sf_dir)
    pulled = pull.pull_range(
        spark, fetch, "2025-06-16T00:00:00Z", fx.store_end(spark, folder), '{job="gw"}', limit=500, volume=volume, sliceEntries="2000"
    )
    return pulled.select("log", "time", "stream")


@query
def pull_pushed(spark, sf_dir):
    """Entries of some hours, one container and one text, by filters that go to the store."""
    fetch, volume = fx.log_store(spark, shared_folder(spark), sf_dir)
    entries = pull.pull_entries(
        spark, fetch, "2025-06-16T00:00:00Z", "2025-12-31T00:00:00Z", '{job="gw"}', labels=("container",), volume=volume
    )
    hours = (F.col("store_time") >= 1750039200000000000) & (F.col("store_time") < 1750104000000000000)
    some = entries.where(hours & (F.col("container") == "gateway") & F.col("line").contains("proxyResponseCode=200"))
    return pull.decoded(some).select("log", "time", "stream")


# --- streams ------------------------------------------------------------------------


@query
def stream_hits_per_second(spark, sf_dir):
    """Day text files as a stream of several batches, counted per second as they arrive."""
    folder = shared_folder(spark)
    days = fx.lines(spark, sf_dir).select(stem_date().alias("day"), "value")
    days.write.partitionBy("day").text(f"{folder}/lines")
    stream = read_lines(spark, f"{folder}/lines", stream=True, files_per_batch=2)
    counts = stream_hits.stream_hits(stream, "internal", cleanse=False, delay="30 days")
    return runs.run_to_table(counts, f"{folder}/hits", f"{folder}/checkpoint", ["second"])


@query
def stream_without_repeats(spark, sf_dir):
    """Records that arrive twice, as from a pull that resumes, once each."""
    folder = shared_folder(spark)
    days = fx.lines(spark, sf_dir).select(stem_date().alias("day"), "value")
    days.union(days).write.partitionBy("day").text(f"{folder}/lines")
    stream = decode_lines(read_lines(spark, f"{folder}/lines", stream=True, files_per_batch=2))
    runs.land_once(stream.select("time", "log"), f"{folder}/once", f"{folder}/checkpoint").awaitTermination()
    return runs.read_landed(spark, f"{folder}/once", "time string, log string").select("time", "log")


@query
def stream_ingest(spark, sf_dir):
    """Day text files as a stream into day-partitioned typed Parquet."""
    folder = shared_folder(spark)
    days = fx.lines(spark, sf_dir).select(stem_date().alias("day"), "value")
    days.write.partitionBy("day").text(f"{folder}/lines")
    stream = read_day_lines(spark, f"{folder}/lines", stream=True)
    runs.ingest_stream(
        ingest.typed_day_lines(stream), f"{folder}/events", f"{folder}/checkpoint"
    ).awaitTermination()
    events = tables.read_events(spark, f"{folder}/events")
    return events.groupBy("day", "apiName").agg(
        F.count(F.lit(1)).alias("events"), F.sum("backendLatency").alias("latency")
    ).withColumn("day", F.col("day").cast("string"))


@query
def stream_landed_days(spark, sf_dir):
    """As ``stream_ingest``, without the file sink, its closed days rewritten while the stream's checkpoint lives."""
    folder = shared_folder(spark)
    days = fx.lines(spark, sf_dir).select(stem_date().alias("day"), "value")
    days.write.partitionBy("day").text(f"{folder}/lines")
    events = ingest.typed_day_lines(read_day_lines(spark, f"{folder}/lines", stream=True))
    runs.land_stream(events, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    runs.compact_days(spark, f"{folder}/events", EVENT_DDL, until="2025-06-19", least=1)
    landed = runs.read_landed(spark, f"{folder}/events", EVENT_DDL)
    return landed.groupBy("day", "apiName").agg(F.count(F.lit(1)).alias("events"), F.sum("backendLatency").alias("latency"))


@query
def events_in_time_order(spark, sf_dir):
    """Typed Parquet of one day per file folder, with the earlier times that follow a later one in a file."""
    folder = shared_folder(spark)
    events = _typed(spark, sf_dir).withColumn("day", stem_date().cast("date")).drop("file_stem", "event_id")
    sinks.write_events(events, folder, compact=True)
    file, place = F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("id")
    read = spark.read.parquet(folder).select("day", "time", file, place)
    before = F.lag("time").over(Window.partitionBy("day", "file").orderBy("id"))
    return read.withColumn("before", before).groupBy(F.col("day").cast("string").alias("day")).agg(F.count_if(F.col("before") > F.col("time")).alias("out_of_order"), F.count(F.lit(1)).alias("events"))
