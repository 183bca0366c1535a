"""Results of micro-batches as folders that become few again.

Every batch is written whole to ``batch=<id>``, and once more if it is replayed. Folding writes
what all folders up to a batch say to ``upto=<id>`` and then deletes what it stands for. A folder
counts once its ``_SUCCESS`` file is there, which is written last, and the newest complete
``upto`` folder makes all batches up to its own number irrelevant, deleted or not. So a
fold that dies at any moment changes nothing, and nothing is ever renamed.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pintulog.shared import remove

DONE = "_SUCCESS"


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of whatever store holds it; none where there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [one.getPath().getName() for one in store.listStatus(where)] if store.exists(where) else []


def names(spark: SparkSession, target: str, kind: str) -> list[str]:
    """The values of the folders ``kind=<value>`` below ``target``, in order."""
    return sorted(n.partition("=")[2] for n in _names(spark, target) if n.startswith(f"{kind}="))


def numbered(spark: SparkSession, target: str, kind: str) -> list[int]:
    """Numbers of the complete folders ``kind=<number>`` below ``target``, in order."""
    numbers = sorted(map(int, names(spark, target, kind)))
    return [n for n in numbers if DONE in _names(spark, f"{target}/{kind}={n}")]


def complete(spark: SparkSession, path: str) -> None:
    """Say of a folder that it is written to its end, as Spark does of those it writes alone."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DONE}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True).close()


def current(spark: SparkSession, target: str, before: int | None = None) -> tuple[int | None, list[int]]:
    """The newest fold, and the batches after it that count (those below ``before``, if given)."""
    folds = numbered(spark, target, "upto")
    last = folds[-1] if folds else None
    batches = [b for b in numbered(spark, target, "batch") if (last is None or b > last) and (before is None or b < before)]
    return last, batches


def folded(spark: SparkSession, target: str) -> int:
    """The last batch that is folded, -1 if none is."""
    return max(numbered(spark, target, "upto"), default=-1)


def paths(spark: SparkSession, target: str, before: int | None = None) -> list[str]:
    last, batches = current(spark, target, before)
    return ([] if last is None else [f"{target}/upto={last}"]) + [f"{target}/batch={b}" for b in batches]


def read(spark: SparkSession, target: str, schema: str, before: int | None = None) -> DataFrame:
    """The rows of all folders that count, with the number of their folder as ``batch``.

    Columns of ``schema`` that are folder names below (``day=``) are read from these.
    """
    last, batches = current(spark, target, before)
    parts = [spark.createDataFrame([], f"{schema}, batch long")]
    for kind, numbers in (("upto", [] if last is None else [last]), ("batch", batches)):
        if numbers:
            rows = spark.read.schema(f"{schema}, {kind} long").option("basePath", target).parquet(*(f"{target}/{kind}={n}" for n in numbers))
            parts.append(rows.withColumnRenamed(kind, "batch"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def fold(
    spark: SparkSession, target: str, schema: str, merge: Callable[[DataFrame], DataFrame], least: int = 2, partition: str | None = None
) -> int | None:
    """Fold all batches that count once there are ``least`` of them; the number folded up to, else None.

    ``merge`` makes the new rows of :func:`read`'s.
    """
    last, batches = current(spark, target)
    if len(batches) < least:
        return None
    writer = merge(read(spark, target, schema)).write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{target}/upto={batches[-1]}")
    forget(spark, target)
    return batches[-1]


def forget(spark: SparkSession, target: str) -> None:
    """Delete every folder that a complete fold stands for, also those an earlier try left."""
    folds = numbered(spark, target, "upto")
    if folds:
        old = [f"upto={n}" for n in names(spark, target, "upto") if int(n) < folds[-1]]
        old += [f"batch={n}" for n in names(spark, target, "batch") if int(n) <= folds[-1]]
        remove(spark, *(f"{target}/{name}" for name in old))
