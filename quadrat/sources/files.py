"""Readers of files that Spark has no reader for, and of folders whose paths carry keys."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zipped_csv(spark: SparkSession, path: str, columns: list[str], member: str = r"\.csv$", delimiter: str = ",") -> DataFrame:
    """All columns as strings of the CSV files inside zip files; nothing is unpacked to disk.

    A zip file is read by one task, row by row; the strings "NA" and "" stay as they are.  Lacking
    columns are null.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if not re.search(member, name):
                            continue
                        with z.open(name) as raw:
                            part = []
                            for r in csv.DictReader(io.TextIOWrapper(raw, "utf-8", newline=""), delimiter=delimiter):
                                part.append([r.get(c) for c in columns])
                                if len(part) == 10_000:
                                    yield pd.DataFrame(part, columns=columns)
                                    part = []
                            yield pd.DataFrame(part, columns=columns)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def coerced(df: DataFrame, numbers: dict[str, str]) -> DataFrame:
    """df with columns cast to numbers; what is none becomes null, and NaN too."""
    cast = lambda c, kind: F.col(c).try_cast(kind)
    return df.withColumns({c: F.when(~F.isnan(cast(c, kind)), cast(c, kind)) if kind in ("double", "float") else cast(c, kind) for c, kind in numbers.items()})


def listed(spark: SparkSession, glob: str, pattern: str, name: str) -> DataFrame:
    """(path, length, name): files of a glob, and what a pattern's first group finds in their paths; contents are not read."""
    files = spark.read.format("binaryFile").load(glob).select("path", "length")
    found = F.regexp_extract("path", pattern, 1)
    return files.select("path", "length", F.when(found != "", found).alias(name))


def keyed_by_path(spark: SparkSession, glob: str, schema: str, pattern: str, keys: list[str], format: str = "csv") -> DataFrame:
    """Rows of the files of a glob, with keys that the groups of a pattern find in their paths."""
    df = spark.read.format(format).schema(schema).option("header", "true").load(glob)
    return df.withColumn("_path", F.input_file_name()).withColumns({k: F.regexp_extract("_path", pattern, i + 1) for i, k in enumerate(keys)}).drop("_path")


def declared(spark: SparkSession, path: str, schema: str, key: list[str] | None = None) -> DataFrame:
    """A Parquet table of a declared schema; NaN becomes null; with a key, a repeated one is an error."""
    df = spark.read.schema(schema).parquet(path)
    df = df.withColumns({f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})
    if key and not df.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} is no key of {path}")
    return df


def tables_of(spark: SparkSession, glob: str, pattern: str, name: str, columns: list[str], without: str) -> DataFrame:
    """The columns of all Parquet tables of a glob that have them, with what a pattern's first group finds in their paths; tables whose name holds `without` are left out.

    There is a table for each run, so their folders are listed and their schemas looked at by the driver.
    """
    from functools import reduce

    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    parts = []
    for at in sorted(s.getPath().toString() for s in found):
        own = re.search(pattern, at)
        if not own or without in own[1]:
            continue
        df = spark.read.parquet(at)
        if set(columns) <= set(df.columns):
            parts.append(df.select(F.lit(own[1]).alias(name), *columns))
    if not parts:
        raise FileNotFoundError(f"no table of {glob} has {columns}")
    return reduce(DataFrame.unionByName, parts)


class Catalog:
    """Tables of a folder by name, each read once, and whether they cover the ids that they should."""

    def __init__(self, spark: SparkSession, root: str, key: str) -> None:
        self.spark, self.root, self.key, self.read = spark, root.rstrip("/"), key, {}

    def table(self, name: str, key: str | None = None) -> DataFrame:
        """A table with its key column under the catalog's name; the same object when it is asked for again."""
        if name not in self.read:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            self.read[name] = df.withColumnRenamed(key, self.key) if key else df
        return self.read[name]

    def coverage(self, ids: DataFrame) -> DataFrame:
        """(table, n_rows, missing): of each table read so far its rows, and how many of the ids it has none for."""
        out = []
        for name, df in self.read.items():
            n = df.agg(F.count("*").alias("n_rows"))
            missing = ids.select(self.key).distinct().join(df.select(self.key), self.key, "left_anti").agg(F.count("*").alias("missing"))
            out.append(n.crossJoin(missing).select(F.lit(name).alias("table"), "n_rows", "missing"))
        from functools import reduce

        return reduce(DataFrame.unionByName, out)


def load_window(sensors: dict[str, DataFrame], box: tuple[float, float, float, float], years: tuple[int, int], bands: list[str]) -> DataFrame:
    """(x, y, day, sensors, bands): observations (x, y, time, bands) of all sensors inside a box and some years, one for each pixel and solar day.

    Bounds, years and the bands that are asked for reach the scans; observations of a day are averaged
    band by band, nulls left out.
    """
    from functools import reduce

    x0, y0, x1, y1 = box
    parts = [df.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1) & F.year("time").between(*years)).select("x", "y", F.to_date("time").alias("day"), F.lit(name).alias("sensor"), *bands) for name, df in sensors.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("x", "y", "day").agg(F.array_join(F.array_sort(F.collect_set("sensor")), "+").alias("sensors"), *[F.avg(b).alias(b) for b in bands])


def flattened(cubes: DataFrame, keys: list[str], curve: str, centre: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(compact, pixels) of curves (keys, y, x, curve) of small cubes: (keys, px, curve) of the centre pixel and of the mean of all, and (keys, y, x, step, v)."""
    pixels = cubes.select(*keys, "y", "x", F.posexplode(F.transform(curve, lambda v: v.cast("double"))).alias("step", "v"))
    is_centre = (F.col("y") == centre[0]) & (F.col("x") == centre[1])
    both = pixels.groupBy(*keys, "step").agg(F.max(F.when(is_centre, F.col("v"))).alias("centre"), F.avg("v").alias("mean"))
    long = both.select(*keys, F.explode(F.array(F.struct(F.lit("centre").alias("px"), "step", F.col("centre").alias("v")), F.struct(F.lit("mean").alias("px"), "step", F.col("mean").alias("v")))).alias("r")).select(*keys, "r.*")
    compact = long.groupBy(*keys, "px").agg(F.transform(F.sort_array(F.collect_list(F.struct("step", "v"))), lambda r: r["v"]).alias("curve"))
    return compact, pixels


def fetched(spark: SparkSession, uri: str, cache: str, size: int | None = None) -> str:
    """The path of a copy of a remote file in a cache folder, by any file system that Spark knows.

    A copy of the right size is not fetched again; a new one is written beside it and renamed when it is
    whole, so a reader never sees a part.  size is the length that the file should have, by default that
    of the remote one; another length is an error.
    """
    import uuid

    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(uri)
    there = source.getFileSystem(conf)
    want = there.getFileStatus(source).getLen() if size is None else size
    own = jvm.org.apache.hadoop.fs.Path(f"{cache.rstrip('/')}/{source.getName()}")
    fs = own.getFileSystem(conf)
    if fs.exists(own) and fs.getFileStatus(own).getLen() == want:
        return own.toString()
    part = jvm.org.apache.hadoop.fs.Path(f"{own.toString()}.{uuid.uuid4().hex}.part")
    jvm.org.apache.hadoop.fs.FileUtil.copy(there, source, fs, part, False, conf)
    if (got := fs.getFileStatus(part).getLen()) != want:
        fs.delete(part, False)
        raise OSError(f"{uri} has {got} bytes, not {want}")
    fs.delete(own, False)
    if not fs.rename(part, own):
        raise OSError(f"{part.toString()} could not be renamed")
    return own.toString()


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file by any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content))
    out.close()
