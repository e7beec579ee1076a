"""Sharding by size-tiered compaction.

A store is a folder: ``data`` has immutable Parquet shards (one folder and one file each), ``manifest``
a table for each version that lists its shards, and ``committed`` an empty file for each version that
counts.  A version comes to be when its file is created, which fails if it is there already: of two
writers that started from one version only one commits, and readers see a whole version or none.

``append`` deals each arrival to small shards by a hash, so that an arrival of any size becomes shards
of about ``small`` bytes.  ``compact`` puts shards into tiers by size (powers of ``fanout``); within a
tier, a window of arrivals and a block of parts, neighbours make runs of about ``target`` bytes, and a
run of ``min_run`` shards or more is merged into one.  Only what is merged is rewritten.  Plans are made
over the manifest, which has a row for each shard; no more than ``WINDOW * PARTS`` of them are ordered
together.  Rows of documents are only counted, dealt and written.

Sizes are bytes of text.  A null text has none.  Rows that are equal in id and text go to one shard.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quadrat.llm.common import TIDY, scratch_path, settings, table

ARRIVAL_DOCS = 2000
SMALL, TARGET, FANOUT, MIN_RUN, WINDOW = 1 << 20, 64 << 20, 4, 4, 4096
#: Parts of an arrival that are planned together.
PARTS = 64
#: Names of shards and counts of arrivals are broadcast up to so many rows (of some 50 bytes).
MAX_BROADCAST_ROWS = 100_000
SHARDS = "shard string, tier int, arrival long, part long, n_rows long, n_bytes long, path string"


class CommitConflict(Exception):
    """Another writer has committed the version."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, small: int = SMALL, target: int = TARGET, fanout: int = FANOUT, min_run: int = MIN_RUN, window: int = WINDOW) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.small, self.target, self.fanout, self.min_run, self.window = small, target, fanout, min_run, window

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def version(self) -> int:
        """The last committed version; 0 for an empty store."""
        fs, p = self._fs(f"{self.root}/committed")
        return max((int(s.getPath().getName()) for s in fs.listStatus(p)), default=0) if fs.exists(p) else 0

    def manifest(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        return self.spark.read.schema(SHARDS).parquet(f"{self.root}/manifest/{self._name(v)}") if v else self.spark.createDataFrame([], SHARDS)

    def _name(self, version: int) -> str:
        return self._text(self._fs(f"{self.root}/committed/{version}")[1])

    def _commit(self, shards: DataFrame, base: int) -> int:
        """Make shards the version after base."""
        name = uuid.uuid4().hex
        shards.select(*[F.col(c.split()[0]) for c in SHARDS.split(", ")]).write.parquet(f"{self.root}/manifest/{name}")
        fs, p = self._fs(f"{self.root}/committed/{base + 1}")
        try:
            out = fs.create(p, False)
        except Exception as e:
            if fs.exists(p):
                raise CommitConflict(f"version {base + 1}") from e
            raise
        out.write(bytearray(name.encode()))
        out.close()
        return base + 1

    def tier(self, size: Column) -> Column:
        steps, top = [], self.small * self.fanout
        while top <= self.target:
            steps.append((size >= top).cast("int"))
            top *= self.fanout
        return reduce(lambda a, b: a + b, steps, F.lit(0))

    def _write(self, rows: DataFrame, total: int) -> str:
        """Write (row, arrival, part, n_bytes, shard), one file for each shard."""
        path = f"{self.root}/data/batch=b{uuid.uuid4().hex}"
        n = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (128 << 20)))
        with settings(self.spark, TIDY):
            rows.repartition(n, "shard").write.partitionBy("shard").option("compression", "zstd").parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        """(batch, shard, row, arrival, part, n_bytes) of some data folders."""
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*paths)

    def _schema(self, docs: DataFrame | None = None) -> StructType | None:
        """The schema of what has been appended; docs sets it, if nothing has."""
        fs, p = self._fs(f"{self.root}/schema")
        if docs is not None and not fs.exists(p):
            out = fs.create(p, True)
            out.write(bytearray(docs.schema.json().encode()))
            out.close()
        return StructType.fromJson(json.loads(self._text(p))) if fs.exists(p) else None

    def _text(self, p) -> str:
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _small(self, names: DataFrame, rows: int) -> DataFrame:
        """A table of so many short rows, to be broadcast if that is less than some ten MB; else the join is left to Spark."""
        return F.broadcast(names) if rows <= MAX_BROADCAST_ROWS else names

    def append(self, docs: DataFrame, arrival: Column, id_col: str = "doc_id", text_col: str = "text") -> int:
        """Add all rows of docs, as small shards of their arrivals; the new version."""
        base = self.version()
        self._schema(docs)
        text, key = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
        sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(arrival, F.lit(-1)).cast("long").alias("arrival"), F.octet_length(text).cast("long").alias("n_bytes"), F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), text)), 1, 8), 16, 10).cast("long").alias("hash"))
        parts = sized.groupBy("arrival").agg(F.greatest(F.lit(1), F.ceil(F.sum("n_bytes") / self.small)).cast("long").alias("parts"), F.sum("n_bytes").alias("all"))
        total, arrivals = parts.agg(F.coalesce(F.sum("all"), F.lit(0)), F.count("*")).first()
        dealt = sized.join(self._small(parts.drop("all"), arrivals), "arrival").withColumn("part", F.pmod(F.col("hash"), F.col("parts")))
        shard = F.concat(F.lit(f"s{base + 1}-"), F.col("arrival"), F.lit("-"), F.col("part"))
        if not arrivals:
            return self._commit(self.manifest(base), base)
        path = self._write(dealt.select("row", "arrival", "part", "n_bytes", shard.alias("shard")), total)
        written = self._read([path])
        made = written.groupBy("shard", "arrival", "part").agg(F.count("*").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
        made = made.select("shard", self.tier(F.col("n_bytes")).alias("tier"), "arrival", "part", "n_rows", "n_bytes", F.lit(path).alias("path"))
        return self._commit(self.manifest(base).unionByName(made), base)

    def plan(self, shards: DataFrame) -> DataFrame:
        """shards with ``run``: the name of the merged shard that each goes to, or null."""
        by = ["tier", "window", "block"]
        own = shards.withColumns({"window": F.floor(F.col("arrival") / self.window), "block": F.floor(F.coalesce("part", F.lit(0)) / PARTS)})
        w = Window.partitionBy(*by).orderBy("arrival", "part", "shard")
        open_ = own.where(F.col("n_bytes") < self.target // 2)
        runs = open_.withColumn("k", F.floor((F.sum("n_bytes").over(w) - F.col("n_bytes")) / self.target))
        size = runs.groupBy(*by, "k").agg(F.count("*").alias("members")).where(F.col("members") >= self.min_run)
        named = runs.join(size, [*by, "k"]).select("shard", F.concat_ws("-", F.concat(F.lit("m"), F.col("tier")), "window", "block", "k").alias("run"))
        return own.drop("window", "block").join(named, "shard", "left")

    def compact(self) -> int:
        """Merge runs of shards of a tier; the new version, or the old one if there is nothing to merge."""
        base = self.version()
        planned = self.plan(self.manifest(base))
        merged = planned.where("run IS NOT NULL")
        groups = merged.groupBy("path").agg(F.sum("n_bytes").alias("n"), F.count("*").alias("shards")).collect()  # one row for each append or compaction that is still in use
        if not groups:
            return base
        names = merged.select("shard", F.concat(F.lit(f"{base + 1}"), F.lit("."), F.col("run")).alias("run"))
        rows = self._read(sorted(g["path"] for g in groups)).drop("batch")
        rows = rows.join(self._small(names, sum(g["shards"] for g in groups)), "shard").select("row", "arrival", "part", "n_bytes", F.col("run").alias("shard"))
        path = self._write(rows, sum(g["n"] for g in groups))
        made = self._read([path]).groupBy("shard").agg(F.min("arrival").alias("arrival"), F.lit(None).cast("long").alias("part"), F.count("*").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
        made = made.select("shard", self.tier(F.col("n_bytes")).alias("tier"), "arrival", "part", "n_rows", "n_bytes", F.lit(path).alias("path"))
        kept = planned.where("run IS NULL").drop("run")
        return self._commit(kept.unionByName(made), base)

    def read(self, version: int | None = None) -> DataFrame:
        """(row, arrival, part, n_bytes, shard) of all rows of a version; none, with the columns of what was appended, if it has none."""
        kept = ["row", "arrival", "part", "n_bytes", "shard"]
        m = self.manifest(version)
        paths = sorted(r["path"] for r in m.select("path").distinct().collect())  # one for each append or compaction in use
        if not paths:
            row = StructField("row", self._schema() or StructType())
            return self.spark.createDataFrame([], StructType([row, *[StructField(k, LongType()) for k in kept[1:4]], StructField("shard", StringType())]))
        return self._read(paths).join(m.select("shard", F.regexp_extract("path", "batch=([^/]*)$", 1).alias("batch")), ["shard", "batch"]).select(*kept)

    def vacuum(self) -> int:
        """Delete data folders that the last version does not use; how many.  Readers of older versions must be done."""
        used = {r["path"].rsplit("/", 1)[1] for r in self.manifest().select("path").distinct().collect()}
        fs, p = self._fs(f"{self.root}/data")
        gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in used] if fs.exists(p) else []
        for g in gone:
            fs.delete(g, True)
        return len(gone)


def op1_size_tiered_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = ShardStore(spark, scratch_path(spark, "shards"))
    docs = table(spark, sf_dir, "documents")
    store.append(docs, F.floor(F.col("doc_id") / ARRIVAL_DOCS))
    store.compact()
    store.vacuum()
    return store.read().select("row.doc_id", "arrival", "part", "n_bytes", "shard")


def _sql() -> str:
    tiers = " + ".join(f"(n_bytes >= {SMALL * FANOUT**k})::INT" for k in range(1, 20) if SMALL * FANOUT**k <= TARGET)
    return f"""
WITH d AS (SELECT doc_id, doc_id // {ARRIVAL_DOCS} AS arrival, strlen(coalesce(text, ''))::BIGINT AS n_bytes, ('0x' || substr(md5(doc_id::VARCHAR || '|' || coalesce(text, '')), 1, 8))::BIGINT AS hash FROM documents),
p AS (SELECT arrival, greatest(1, ceil(sum(n_bytes) / {SMALL}))::BIGINT AS parts FROM d GROUP BY 1),
x AS (SELECT doc_id, arrival, n_bytes, hash % parts AS part FROM d JOIN p USING (arrival)),
s AS (SELECT arrival, part, sum(n_bytes)::BIGINT AS n_bytes FROM x GROUP BY ALL),
t AS (SELECT *, {tiers} AS tier, arrival // {WINDOW} AS win, part // {PARTS} AS block FROM s),
k AS (SELECT *, (sum(n_bytes) OVER (PARTITION BY tier, win, block ORDER BY arrival, part) - n_bytes)::BIGINT // {TARGET} AS k FROM t WHERE n_bytes < {TARGET // 2}),
m AS (SELECT arrival, part, CASE WHEN count(*) OVER (PARTITION BY tier, win, block, k) >= {MIN_RUN} THEN '2.m' || tier || '-' || win || '-' || block || '-' || k END AS run FROM k)
SELECT doc_id, arrival, part, n_bytes, coalesce(run, 's1-' || arrival || '-' || part) AS shard FROM x LEFT JOIN m USING (arrival, part)
"""


QUERIES = {"op1_size_tiered_shards": op1_size_tiered_shards}
SQL = {"op1_size_tiered_shards": _sql()}
