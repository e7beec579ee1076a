"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

1.  Equal vectors of a label are one class and go on with one representative that knows their number.
2.  On a bounded sample a rotation is learned (PCA, then ITQ), so that the signs of the rotated
    components are balanced bits.  Every vector is coded.
3.  Each table indexes the codes by some of their bits.  Vectors of a label that agree on all bits of
    some table meet in a bucket.  Bits and tables follow from the number of vectors of the label itself,
    so that the buckets of a large label and of a small one keep the same size, however large it is, and
    a pair at ``sure`` cosine is missed with a chance of 1 % at most.
4.  In a bucket the original vectors are compared in double precision, in blocks.  A pair counts in the
    first table in which it meets.  Only counts and a spanning forest of the links leave a bucket, so
    a group of m near copies gives m rows, not m * m.

A bucket larger than ``BLOCK`` is dealt out as pairs of blocks to different tasks, none left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import drop_scratch, materialize, table
from quadrat.operators.graph import connected_components

MIN_COSINE = 0.93
#: Rows of which the rotation is learned: those of the least hash of the vector.
MAX_SAMPLE = 4096
BITS, BLOCK = 64, 1024


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) whose signs are balanced codes; deterministic."""
    mean = sample.mean(axis=0)
    x = sample - mean
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    w = vt[: min(bits, len(vt))].T
    v = x @ w
    r, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((w.shape[1], w.shape[1])))
    for _ in range(rounds):
        b = np.where(v @ r >= 0, 1.0, -1.0)
        u, _, wt = np.linalg.svd(b.T @ v)
        r = (u @ wt).T
    return mean, w @ r


def width_for(n: Column) -> Column:
    """How many bits a table takes for a label of n vectors: buckets of some dozens."""
    return F.greatest(F.lit(6), F.round(F.log2(n / 32))).cast("int")


def tables_for(width: int, bits: int, sure: float = 0.95, miss: float = 0.01) -> list[list[int]]:
    """The bits of each table of so many of them: few enough misses.

    Two vectors at an angle differ in a bit with a chance of angle / pi.
    """
    width = max(1, min(bits, width))
    hit = (1 - math.acos(sure) / math.pi) ** width
    count = max(1, math.ceil(math.log(miss) / math.log(1 - hit)))
    rng, deck, out = np.random.default_rng(11), [], []
    for _ in range(count):
        if len(deck) < width:  # all bits are used before one is used again
            deck += rng.permutation(bits).tolist()
        own = list(dict.fromkeys(deck))[:width]
        for b in own:
            deck.remove(b)
        out.append(sorted(own))
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    rows = column.to_numpy(zero_copy_only=False)
    return np.stack([np.asarray(x, np.float64) for x in rows]) if len(rows) else np.empty((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid(embedding, label):
    """Vectors that can be linked: with a label, no null or non-finite component, not zero."""
    e = F.col(embedding)
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return F.coalesce(F.col(label).isNotNull() & e.isNotNull() & F.forall(e, lambda c: F.coalesce(fine(c), F.lit(False))) & F.exists(e, lambda c: c != 0), F.lit(False))


def _bucket_rows(reps: DataFrame, mean: np.ndarray, proj: np.ndarray, tables: list[list[int]]) -> DataFrame:
    """(bucket, v, times, code, vec): each vector once for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            if not b.num_rows:
                continue
            vecs = b.column(3)
            bits = (_unit(_vectors(vecs)) - mean) @ proj >= 0
            code = pa.array([r.tobytes() for r in np.packbits(bits, axis=1)], pa.binary())
            for k, own in enumerate(tables):
                part = np.packbits(bits[:, own], axis=1)
                keys = [xxhash.xxh3_64_intdigest(p.tobytes() + f"{k}|{label}".encode()) >> 1 for p, label in zip(part, b.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([k] * len(keys), pa.int32()), b.column(0), b.column(1), code, b.column(2), vecs], names=["bucket", "tab", "v", "times", "code", "label", "vec"])

    kind = reps.schema["vec"].dataType.simpleString()
    label = reps.schema["label"].dataType.simpleString()
    return reps.select("v", "times", "label", "vec").mapInArrow(run, f"bucket long, tab int, v long, times long, code binary, label {label}, vec {kind}")


def _compare(rows: DataFrame, tables: list[list[int]], least: float) -> DataFrame:
    """(kind 0: v, links) and (kind 1: a, b of a spanning forest) from rows sorted by (bucket, x, y, side).

    Rows of one (bucket, x, y) are the vectors of block x and of block y of a bucket, or of one block.
    """
    masks = []
    for own in tables:
        m = np.zeros(BITS, bool)
        m[own] = True
        masks.append(m)

    def links(tab: int, a: tuple, b: tuple, same: bool) -> tuple[np.ndarray, np.ndarray]:
        (_, _, ca, la, xa), (_, _, cb, lb, xb) = a, b
        near = xa @ xb.T >= least
        if len({*la, *lb}) > 1:  # two labels whose keys hash alike
            near &= np.array(la, object)[:, None] == np.array(lb, object)[None, :]
        if same:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        differ = ca[i] != cb[j]
        keep = ~(differ & masks[tab]).any(axis=1)
        for k in range(tab):
            keep &= (differ & masks[k]).any(axis=1)  # the pair has met in no earlier table
        return i[keep], j[keep]

    def unpack(group: list[tuple]) -> tuple:
        code = np.unpackbits(np.frombuffer(b"".join([r[2] for r in group]), np.uint8).reshape(len(group), -1), axis=1)
        bits = np.zeros((len(group), BITS), bool)
        bits[:, : code.shape[1]] = code[:, :BITS]
        vecs = _unit(np.stack([np.asarray(r[4], np.float64) for r in group]))
        return np.array([r[0] for r in group], np.int64), np.array([r[1] for r in group], np.int64), bits, [r[3] for r in group], vecs

    def solve(tab: int, one: bool, left: list[tuple], right: list[tuple], out: dict[int, int], edges: list[tuple[int, int]]) -> None:
        if not left or (one and len(left) < 2) or (not one and not right):
            return
        a = unpack(left)
        b = a if one else unpack(right)
        i, j = links(tab, a, b, one)
        for v, times, at, other in ((a[0], b[1], i, j), (b[0], a[1], j, i)):
            sums = np.bincount(at, weights=times[other], minlength=len(v))
            for k in np.nonzero(sums)[0]:
                out[int(v[k])] = out.get(int(v[k]), 0) + int(sums[k])
        ids = a[0] if one else np.concatenate([a[0], b[0]])
        parent = list(range(len(ids)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(i.tolist(), (j if one else j + len(a[0])).tolist(), strict=True):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[rx] = ry
                edges.append((int(ids[x]), int(ids[y])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, left, right = None, [], []
        out: dict[int, int] = {}
        edges: list[tuple[int, int]] = []

        def flush() -> pa.RecordBatch:
            kinds = [0] * len(out) + [1] * len(edges)
            batch = pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array([*out, *[a for a, _ in edges]], pa.int64()), pa.array([*out.values(), *[b for _, b in edges]], pa.int64())], names=["kind", "a", "b"])
            out.clear()
            edges.clear()
            return batch

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(5)]
            rest = [batch.column(i) for i in range(5, 10)]
            vals = [c.to_pylist() for c in rest[:4]] + [rest[4].to_numpy(zero_copy_only=False)]
            for bucket, x, y, side, tab, *row in zip(*cols, *vals, strict=True):
                if (bucket, x, y, tab) != key:
                    if key:
                        solve(key[3], key[1] == key[2], left, right, out, edges)
                    key, left, right = (bucket, x, y, tab), [], []
                    if len(out) + len(edges) > 100_000:
                        yield flush()
                (right if side else left).append(tuple(row))
        if key:
            solve(key[3], key[1] == key[2], left, right, out, edges)
        yield flush()

    return rows.select("bucket", "x", "y", "side", "tab", "v", "times", "code", "label", "vec").mapInArrow(run, "kind int, a long, b long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = MIN_COSINE, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, zero, of no label, or hold a null or non-finite component link with nothing:
    0 links, and a component of their own.  Vectors of different length link with nothing either: the
    length counts as part of the label.  Repeated rows are different vectors that link with each other.
    A null id never names a component that has an id in it.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vec"), F.col(f"`{label_col}`").alias("_label"))
    own = own.withColumn("label", F.when(F.col("_label").isNotNull(), F.concat_ws("|", F.col("_label").cast("string"), F.size("vec").cast("string"))))
    own = own.withColumn("key", F.when(valid("vec", "label"), F.sha2(F.concat_ws("|", "label", F.array_join(F.transform("vec", lambda c: (c + F.lit(0.0)).cast("string")), ",")), 256)))
    rows = materialize(own.select("vec_id", "key"), "vectors")
    reps = own.where(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("times"), F.min("vec_id").alias("least_id"), F.min("label").alias("label"), F.min("vec").alias("vec"))
    keyed = materialize(reps, "vector-keys")
    sizes = keyed.groupBy("label").agg(width_for(F.count("*")).alias("width"))
    reps = keyed.join(sizes, "label").select(F.monotonically_increasing_id().alias("v"), "key", "times", "least_id", "label", "vec", "width")
    reps = materialize(reps, "vector-classes")
    drop_scratch(keyed)
    # a row for each length of vectors, and for each width, of which there are some dozens
    groups = reps.groupBy(F.size("vec").alias("d")).agg(F.sort_array(F.collect_set("width")).alias("widths")).collect()
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found, scratch = None, []
    for g in sorted(groups, key=lambda g: g["d"]):
        some = reps.where(F.size("vec") == g["d"])
        sample = np.array([r["vec"] for r in some.orderBy(F.xxhash64("key"), "key").select("vec").limit(max_sample).collect()], np.float64)
        mean, proj = learn_rotation(_unit(sample))
        for width in g["widths"]:
            tables = tables_for(width, proj.shape[1])
            coded = materialize(_bucket_rows(some.where(F.col("width") == width), mean, proj, tables), "codes")
            scratch.append(coded)
            buckets = coded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
            dealt = coded.join(buckets, "bucket").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
            dealt = dealt.withColumn("blk", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
            # a vector goes to each pair of its block with another, and to its block alone
            dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            dealt = dealt.withColumns({"x": F.least("blk", "o"), "y": F.greatest("blk", "o"), "side": (F.col("blk") > F.col("o")).cast("int")})
            dealt = dealt.repartition(parts, "bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "tab")
            one = _compare(dealt, tables, least)
            found = one if found is None else found.union(one)
    if found is None:
        found = spark.createDataFrame([], "kind int, a long, b long")
    found = materialize(found, "vector-links")
    for done in scratch:
        drop_scratch(done)
    counts = found.where("kind = 0").groupBy(F.col("a").alias("v")).agg(F.sum("b").alias("links"))
    comps = connected_components(found.where("kind = 1").select("a", "b"))
    named = reps.select("v", "key", "times", "least_id").join(counts, "v", "left").join(comps, F.col("v") == F.col("vertex"), "left")
    named = materialize(named.select("key", "least_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "v").alias("c")), "vector-components")
    ids = named.groupBy("c").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(ids, "c").select("key", "n_links", "component_id")
    out = rows.join(by_key, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("vec_id", id_col)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_embedding_near_dedup": op7_embedding_near_dedup}
SQL: dict[str, str] = {}
