"""Starting streams: typed ingest, and results kept current in a table."""

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pintulog.functions.timestamps import wall_clock
from pintulog.shared import drop_settled, remove, settle
from pintulog.sinks import UNKNOWN_DAY
from pintulog.streaming import folders

FOLD_AFTER = 16  # batches of a result table that are folded together
EVENT_WAIT = 300.0  # seconds for the events of a run that has ended


class LateRows(RuntimeError):
    """Rows came later than the watermark allows and were left out."""


def ingest_stream(
    events: DataFrame, target: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append typed events (with ``day``) to day-partitioned Parquet, exactly once.

    ``once`` takes in everything there is now and stops; otherwise the stream stays up.
    """
    writer = (
        events.writeStream.format("parquet")
        .partitionBy("day")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


class _Late(StreamingQueryListener):
    """Rows that stateful operators dropped as too late, by run, over all batches however many."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        with self.changed:
            run = str(event.progress.runId)
            self.rows[run] = self.rows.get(run, 0) + late

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()


def run_complete(spark: SparkSession, start: Callable[[], StreamingQuery]) -> None:
    """Run the stream that ``start`` starts to its end; :class:`LateRows` if it dropped any.

    Events come in order, the end of the run last, so by then every batch is counted.
    """
    heard = _Late()
    spark.streams.addListener(heard)
    try:
        run = start()
        run.awaitTermination()
        with heard.changed:
            if not heard.changed.wait_for(lambda: str(run.runId) in heard.ended, EVENT_WAIT):
                raise RuntimeError("the end of the stream was not reported, so late rows may be uncounted")
    finally:
        spark.streams.removeListener(heard)
    if late := heard.rows.get(str(run.runId), 0):
        raise LateRows(f"{late} rows came later than the watermark allows; use a longer delay")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def run_to_table(counts: DataFrame, target: str, checkpoint: str, keys: list[str], fold_after: int = FOLD_AFTER) -> DataFrame:
    """Run an aggregating stream over what has arrived; the latest row per key.

    Update mode emits only the groups a batch changed. Each batch is a folder of its
    own, overwritten if the batch is replayed, so a retry never counts twice; after every
    ``fold_after`` batches they become one folder of latest rows, so a read never
    touches more folders than that (:mod:`pintulog.streaming.folders`). Rows dropped as too
    late fail the run (:class:`LateRows`): the table would be incomplete. Without input
    the table is empty.
    """
    spark = counts.sparkSession
    schema = _ddl(counts)
    values = [c for c in counts.columns if c not in keys]

    def latest(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*values), "batch").alias("last")
        return rows.groupBy(*keys).agg(last).select(*keys, *[F.col("last")[v].alias(v) for v in values])

    def keep(batch: DataFrame, batch_id: int) -> None:
        if folders.folded(spark, target) >= batch_id:
            return  # a replay of a batch that is folded already
        # this batch may be replayed, so only those before it are folded
        folders.fold(spark, target, schema, latest, fold_after)
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = (
        counts.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
    )
    run_complete(spark, writer.start)
    return latest(folders.read(spark, target, schema))


def run_to_files(rows: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Append the rows of a stream to Parquet over what has arrived, and read them.

    Fails with :class:`LateRows` like :func:`run_to_table`.
    """
    writer = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    run_complete(rows.sparkSession, writer.start)
    return rows.sparkSession.read.schema(rows.schema).parquet(target)


def days_path(target: str, day: str) -> str:
    return f"{target}/day={day}"


def land_batch(rows: DataFrame, target: str, batch_id: int) -> None:
    """Rows with a text column ``day`` as folder ``batch=`` below ``day=``, all days in one job.

    A batch that is replayed writes the same days again. Days that are folded up to it stay as
    they are.
    """
    spark = rows.sparkSession
    known = folders.names(spark, target, "day")
    done = [day for day in known if folders.folded(spark, days_path(target, day)) >= batch_id]
    # what an earlier try has left
    remove(spark, *(f"{days_path(target, day)}/batch={batch_id}" for day in known if day not in done))
    kept = rows.where(~F.col("day").isin(done)) if done else rows
    kept.withColumn("batch", F.lit(batch_id)).write.mode("append").partitionBy("day", "batch").parquet(target)
    for day in folders.names(spark, target, "day"):
        if day not in done and str(batch_id) in folders.names(spark, days_path(target, day), "batch"):
            folders.complete(spark, f"{days_path(target, day)}/batch={batch_id}")


def read_landed(spark: SparkSession, target: str, schema: str, days: list[str] | None = None, before: int | None = None) -> DataFrame:
    """The rows of landed days (all, or those named) with their ``day``; no other folder is opened."""
    known = folders.names(spark, target, "day") if days is None else days
    whole = spark.createDataFrame([], f"{schema}, day string")
    by_kind: dict[str, list[str]] = {}
    for day in known:
        for path in folders.paths(spark, days_path(target, day), before):
            by_kind.setdefault(path.rpartition("/")[2].partition("=")[0], []).append(path)
    for kind, found in by_kind.items():
        rows = spark.read.schema(f"{schema}, day string, {kind} long").option("basePath", target).parquet(*found)
        whole = whole.unionByName(rows.drop(kind))
    return whole


def compact_days(spark: SparkSession, target: str, schema: str, until: str, least: int = 2, files: int = 1) -> dict[str, int]:
    """Rewrite the days before ``until`` that have ``least`` folders or more, as ``files`` files each.

    Where these would be too large, adaptive execution splits them, so no day passes through a few tasks.

    Only closed days, which no running stream writes any more. Returns the days with the
    number of their last batch. A rewrite that dies leaves the day as it was.
    """
    done = {}
    for day in folders.names(spark, target, "day"):
        if day < until:
            number = folders.fold(spark, days_path(target, day), schema, lambda rows: rows.drop("batch").hint("rebalance", files), least)
            if number is not None:
                done[day] = number
    return done


def land_stream(rows: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Land rows with a ``day`` below ``day=``, exactly once, without a growing log of files.

    Unlike the file sink of :func:`ingest_stream`, the days can be compacted while the stream lives
    (:func:`compact_days`); :func:`read_landed` reads them.
    """
    writer = rows.writeStream.foreachBatch(
        lambda batch, batch_id: land_batch(batch.withColumn("day", F.coalesce(F.col("day").cast("string"), F.lit(UNKNOWN_DAY))), target, batch_id)
    ).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def land_once(records: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Land each (time, log) of a stream of records once, below the ``day=`` of its time.

    For sources that deliver records again, like a pull that starts anew. A batch is
    read once and compared with what has landed for its days, so records may come as late as
    they like and nothing is kept in memory; those with an unreadable time lie
    under ``day=unknown`` and are compared with each other only. Of equal records the smallest in
    the other columns stays. A column ``record_key`` is added.
    """
    key = F.unhex(F.sha2(F.concat(F.octet_length("time").cast("string"), F.lit(":"), "time", "log"), 256))

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        others = [c for c in batch.columns if c not in ("time", "log")]
        day = F.coalesce(F.to_date(wall_clock("time")).cast("string"), F.lit(UNKNOWN_DAY))
        # the batch is computed here and nowhere else; its rows are dealt out once, by key
        staged = settle(batch.withColumn("day", day))
        days = [r.day for r in staged.select("day").distinct().collect()]
        keyed = staged.withColumn("record_key", key)
        fresh = keyed.groupBy("day", "record_key").agg(F.min(F.struct("time", "log", *others)).alias("row")).select("day", "record_key", "row.*")
        landed = read_landed(spark, target, "record_key binary", days, before=batch_id)
        land_batch(fresh.join(landed, ["day", "record_key"], "left_anti"), target, batch_id)
        drop_settled(staged)

    writer = records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
