"""Tables written into the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what spark.checkpoint.dir names.  Only where that is unset, as in local tests, a temporary
    folder is taken, and remembered in the session so that later calls find the same one.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("quadrat.scratch.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="quadrat-")
        spark.conf.set("quadrat.scratch.dir", at)
    return at.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quadrat/{name}-{uuid.uuid4().hex}"


#: Spark deletes the shuffle files of a query when the query ends; for writes, whose rows are read from what they have written.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Meanwhile the session has these settings."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: this cuts the lineage, and a lost executor costs nothing of it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with settings(spark, TIDY):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete what materialize() wrote for df; df must not be read again."""
    spark = df.sparkSession
    for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        if "/quadrat/" in path:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
