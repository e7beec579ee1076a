"""Writers: partitioned runs, upserts by partition, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_run(df: DataFrame, path: str, keys: tuple[str, ...] = ("run_id", "scheme")) -> None:
    """Rows under one folder for each combination of keys."""
    df.write.mode("append").partitionBy(*keys).parquet(path)


def upsert(df: DataFrame, path: str, keys: tuple[str, ...] = ("run_id", "scheme")) -> None:
    """Replace the folders of the keys that df has; others stay.  A failed write leaves the old folders."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append_manifest(df: DataFrame, path: str, schema: str) -> None:
    """Append rows with the pinned columns of a schema; lacking ones are null, others are refused."""
    wanted = df.sparkSession.createDataFrame([], schema).schema
    extra = set(df.columns) - set(wanted.names)
    if extra:
        raise ValueError(f"columns not in the manifest: {sorted(extra)}")
    df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]).write.mode("append").parquet(path)


def write_versioned(df: DataFrame, path: str, suffix: str) -> str:
    """Write to path + suffix, which must not be there yet."""
    df.write.mode("errorifexists").parquet(path + suffix)
    return path + suffix


def markdown(df: DataFrame, most: int = 500) -> str:
    """A small table as Markdown; more than `most` rows are refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for a table in a document")
    line = lambda cells: "| " + " | ".join("" if c is None else f"{c:.3f}" if isinstance(c, float) else str(c) for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, rows)])


def write_series(obs: DataFrame, path: str, keys: list[str], variables: list[str]) -> None:
    """Series of pixels (keys, centre, variables) under a folder for each variable and px: the centre pixel's value, and the mean of all pixels that have one with their number; what is masked has no row."""
    sums = [e for v in variables for e in (F.avg(F.when(F.col("centre"), F.col(v))).alias(f"{v}_c"), F.avg(v).alias(f"{v}_m"), F.count(v).alias(f"{v}_n"))]
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(px).alias("px"), F.col(f"{v}_{c}").alias("value"), n.alias("n_px")) for v in variables for px, c, n in (("centre", "c", F.lit(1).cast("long")), ("mean5x5", "m", F.col(f"{v}_n")))])
    long = obs.groupBy(*keys).agg(*sums).select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*").where("value IS NOT NULL")
    long.write.mode("overwrite").partitionBy("variable", "px").parquet(path)


def write_tiles(df: DataFrame, path: str, bands: list[str], tags: dict[str, str], keys: tuple[str, ...] = ("tile", "year")) -> None:
    """Raster tiles in long form: (keys, row, col, band, value) under a folder for each tile and year, with a table of band names and tags beside them.

    What a band lacks has no row.
    """
    import json

    cells = df.select(*keys, "row", "col", F.explode(F.array(*[F.struct(F.lit(i + 1).alias("band"), F.col(b).cast("float").alias("value")) for i, b in enumerate(bands)])).alias("b")).select(*keys, "row", "col", "b.*").where("value IS NOT NULL")
    cells.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{path}/cells")
    rows = [(i + 1, b, json.dumps(tags, sort_keys=True)) for i, b in enumerate(bands)]
    df.sparkSession.createDataFrame(rows, "band int, name string, tags string").write.mode("overwrite").parquet(f"{path}/bands")


def read_tiles(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(keys, row, col, name, value) of what write_tiles() wrote; schema has the keys."""
    cells = spark.read.schema(f"row long, col long, band int, value float, {schema}").parquet(f"{path}/cells")
    return cells.join(F.broadcast(spark.read.parquet(f"{path}/bands").select("band", "name")), "band").drop("band")
