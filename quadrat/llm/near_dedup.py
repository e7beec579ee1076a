"""Near-duplicate documents by bottom-k sketches of one hash function, with exact confirmation.

1.  A text's set is its distinct word shingles, as 64-bit hashes.  Equal sets are one class at once; a
    class goes on with one representative, so copies never meet each other.
2.  The sketch keeps the ``sketch`` least hashes.  The ``indexed`` least of them go to inverted lists.
    Two sets of Jaccard similarity t share none of them with a chance of (1 - t) ** indexed at most:
    1e-13 for 0.85 and 16 values, 1e-11 for 0.8.
3.  A short list gives its pairs.  A long one gives only the pairs with its hub, the member with most
    company in its lists, which makes most of a group of near copies one component.
4.  The bottom-k of the union of two sketches estimates the similarity; pairs that are clearly below
    the threshold (by six standard deviations) go.  The rest is confirmed on the full sets.
5.  Two documents are compared at the latest when they share any indexed value: a document that has
    more than a few values in long lists is *doubtful*, and doubtful documents are compared with each
    other in every long list of theirs that still holds several components.  There an inverted index
    of the full sets counts all intersections exactly, block by block; blocks are bounded in rows and
    in bytes, and only edges that join two components leave them, so a group of m copies gives m rows
    at most.  A document that is not doubtful has at most l long values (``most_long``), so a pair that
    shares none but long ones shares at most l of the least ``indexed`` values of its union: a chance
    of P(Bin(indexed, t) <= l), which is 1e-6 at most.  Nothing is capped or dropped.

The links give connected components.  Sets of documents whose sketches met anything are computed from
whole texts; no other text is moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import arrow_batches, byte_slices, drop_scratch, materialize, table
from quadrat.llm.worker import state
from quadrat.operators.graph import connected_components

SKETCH, INDEXED, SHORT_LIST, MISS = 32, 16, 16, 1e-6
#: Rows, and bytes of full sets, of a block of a long list.
BLOCK, BLOCK_BYTES = 4096, 4 << 20
#: Bytes of full sets that a round moves at least; more where all sets together have more.
ROUND_BYTES = 256 << 20
#: Bytes of words whose hashes a Python worker keeps.
WORD_CACHE = 48 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


class _Hashes(dict):
    """Word to 64-bit hash, for words of up to 100 bytes; starts anew when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 100:
            if len(self) * 200 > WORD_CACHE:
                self.clear()
            self[word] = h
        return h


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct hashes (63 bits, as signed numbers) of a text's shingles; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.int64)
    w = np.fromiter(map(state("words", _Hashes).__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - width + 1)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(min(width, len(w))):
            h = (h ^ (h >> np.uint64(29))) * _M1 + w[k : k + n]
        h ^= h >> np.uint64(32)
        h *= _M2
        h ^= h >> np.uint64(29)
        h *= _M3
        h ^= h >> np.uint64(32)
    return np.unique((h >> np.uint64(1)).astype(np.int64))


def sketches(docs: DataFrame, width: int, sketch: int = SKETCH) -> DataFrame:
    """(doc_id, text_key, n, set_key, sketch) of every row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in byte_slices(batches, 2, 500):
            sets = [shingle_set(t, width) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s[:sketch] for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n", "set_key", "sketch"],
            )

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, "doc_id long, text_key long, n long, set_key binary, sketch array<long>")


def _full_sets(texts: DataFrame, width: int) -> DataFrame:
    """(v, set) of (v, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 1, 500):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, width).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["v", "set"])

    return texts.select("v", "text").mapInArrow(run, "v long, set binary")


def _confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) with den * intersection >= num * union on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 2, 1024):
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = int(np.isin(x, y, assume_unique=True, kind="sort").sum()) if len(x) and len(y) else 0
                keep.append(bool(both and den * both >= num * (len(x) + len(y) - both)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("v").alias("a"), F.col("set").alias("set_a"))
    y = sets.select(F.col("v").alias("b"), F.col("set").alias("set_b"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def joining_edges(flat: np.ndarray, sizes: np.ndarray, labels: np.ndarray, split: int, num: int, den: int) -> list[tuple[int, int]]:
    """Edges (i, j) of similar sets that join different labels until none is left to join.

    flat has the elements of all sets, one set after another.  With split = len(sizes) all sets are
    compared; else those before split with those from it on.  Two sets of the most frequent label need
    no comparison, so only the others are looked up.
    """
    n = len(sizes)
    _, element, times = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    by_element = owner[np.argsort(element, kind="stable")]
    ends = np.cumsum(times)
    starts, at = ends - times, np.concatenate([[0], np.cumsum(sizes)])
    found, first, counts = np.unique(labels, return_index=True, return_counts=True)
    labels, most = labels.copy(), first[np.argmax(counts)]
    out = []
    for i in np.flatnonzero(labels != labels[most]).tolist():
        there = slice(0, n) if split == n else slice(split, n) if i < split else slice(0, split)
        if (labels[there] == labels[i]).all():
            continue
        own = element[at[i] : at[i + 1]]
        own = own[times[own] > 1]
        if not len(own):
            continue
        both = np.bincount(np.concatenate([by_element[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]), minlength=n)[there]
        near = np.flatnonzero((both > 0) & (den * both >= num * (sizes[i] + sizes[there] - both)) & (labels[there] != labels[i])) + there.start
        if len(near):
            found, first = np.unique(labels[near], return_index=True)
            out += [(i, int(j)) for j in near[first]]
            labels[np.isin(labels, found)] = labels[i]
    return out


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all 8-byte numbers in a binary column without nulls, how many each row has)."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data.copy().view(np.int64), np.diff(ends) // 8


def _search_lists(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) across components, from (value, x, y, side, v, component, set) sorted by the first three."""

    def solve(key: tuple, parts: list[tuple]) -> pa.RecordBatch:
        side, v, component, sizes, flat = (np.concatenate([p[k] for p in parts]) for k in range(5))
        one, edges = key[1] == key[2], []
        if len(np.unique(component)) > 1 and (one or len(np.unique(side)) == 2):
            order = np.argsort(side, kind="stable")
            if (order != np.arange(len(order))).any():
                starts = np.cumsum(sizes) - sizes
                flat = np.concatenate([flat[a : a + n] for a, n in zip(starts[order].tolist(), sizes[order].tolist(), strict=True)])
                v, component, sizes = v[order], component[order], sizes[order]
            split = len(side) if one else int((side == 0).sum())
            edges = joining_edges(flat, sizes, component, split, num, den)
        return pa.RecordBatch.from_arrays([pa.array([int(v[e[k]]) for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for b in byte_slices(batches, 6, BLOCK):
            value, x, y, side, v, component = (b.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            flat, sizes = _numbers(b.column(6))
            at = np.concatenate([[0], np.cumsum(sizes)])
            new = np.flatnonzero((value[1:] != value[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(v)], strict=True):
                own = (int(value[lo]), int(x[lo]), int(y[lo]))
                if own != key:
                    if key:
                        yield solve(key, parts)
                    key, parts = own, []
                parts.append((side[lo:hi], v[lo:hi], component[lo:hi], sizes[lo:hi], flat[at[lo] : at[hi]]))
        if key:
            yield solve(key, parts)

    return rows.select("value", "x", "y", "side", "v", "component", "set").mapInArrow(run, "a long, b long")


def _rounds(total: int | None, sets: int | None) -> int:
    """In how many rounds rows with sets of `total` bytes are moved, so that none moves more than about all sets once."""
    return max(1, -(-(total or 0) // max(ROUND_BYTES, sets or 0)))


def most_long(t: float, indexed: int, miss: float = MISS) -> int:
    """The largest l with P(Bin(indexed, t) <= l) <= miss; -1 if there is none."""
    chance = 0.0
    for k in range(indexed + 1):
        chance += math.comb(indexed, k) * t**k * (1 - t) ** (indexed - k)
        if chance > miss:
            return k - 1
    return indexed


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", sketch: int = SKETCH, indexed: int = INDEXED, short_list: int = SHORT_LIST) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; documents are linked if den * intersection >= num * union.

    A null, empty or blank text has no shingles and is linked with nothing: its component is itself.
    Repeated rows are in one component; a null id takes part in links but never names a component that
    has an id in it, and is kept only where its component has no id.  Other columns are not looked at.
    """
    with arrow_batches(docs.sparkSession):
        return _near_duplicates(docs, width, num, den, id_col, text_col, sketch, indexed, short_list)


def _near_duplicates(docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str, sketch: int, indexed: int, short_list: int) -> DataFrame:
    t, scratch = num / den, []

    def table_of(df: DataFrame, name: str) -> DataFrame:
        scratch.append(materialize(df, name))
        return scratch[-1]

    text = F.col(f"`{text_col}`")
    texts_of = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"))
    rows = materialize(sketches(texts_of, width, sketch), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "n", "sketch"))
    reps = materialize(rows.where("n > 0").groupBy("set_key").agg(first.alias("r")).select(F.monotonically_increasing_id().alias("v"), "set_key", "r.doc_id", "r.text_key", "r.n", "r.sketch"), "representatives")

    # inverted lists of the retained values
    entries = reps.select("v", F.explode(F.slice("sketch", 1, indexed)).alias("value"))
    lists = entries.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    tagged = table_of(entries.join(table_of(lists, "lists"), "value"), "tagged")
    long_lists = tagged.where(F.col("size") > short_list)
    in_long = table_of(long_lists.groupBy("v").agg(F.count("*").alias("long"), F.sum("size").alias("company")), "in-long")
    hubs = long_lists.join(in_long, "v").groupBy("value").agg(F.max(F.struct("company", "v"))["v"].alias("hub"))
    members = tagged.where(F.col("size") <= short_list).groupBy("value").agg(F.collect_list("v").alias("m"))
    short = members.select("m", F.explode("m").alias("a")).select("a", F.explode(F.filter("m", lambda x: x > F.col("a"))).alias("b"))
    stars = long_lists.join(table_of(hubs, "hubs"), "value").where("v != hub").select(F.least("v", "hub").alias("a"), F.greatest("v", "hub").alias("b"))
    met = short.union(stars).distinct()

    # the estimate from the union of two sketches
    side = lambda x: reps.select(F.col("v").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, sketch)
    shared = F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))
    least = max(0.0, t - 6 * math.sqrt(t * (1 - t) / sketch))
    likely = met.join(side("a"), "a").join(side("b"), "b").where((den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")) & (shared >= least * F.size(union)))
    pairs = table_of(likely.select("a", "b", "n_a"), "pairs")

    # full sets of whatever may have to be confirmed
    # a set that is indexed whole may share more with a partner than the partner has indexed
    beyond = F.greatest(F.lit(0), F.floor(den * F.col("n") / num) - indexed)
    unsure = F.when(F.col("n") <= indexed, den * (F.col("long") + beyond) >= num * F.col("n")).otherwise(F.col("long") > most_long(t, indexed))
    doubtful = table_of(in_long.join(reps.select("v", "n"), "v").where(unsure).select("v", "n"), "doubtful")
    needed = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).union(doubtful.select("v")).distinct()
    wanted = needed.join(reps.select("v", "doc_id", "text_key"), "v").select("v", F.coalesce("doc_id", F.lit(-1)).alias("_d"), F.col("doc_id").isNull().alias("_null"), "text_key")
    keyed = texts_of.select(F.coalesce("doc_id", F.lit(-1)).alias("_d"), F.col("doc_id").isNull().alias("_null"), "text_key", "text")
    texts = keyed.join(wanted, ["_d", "_null", "text_key"]).select("v", "text")
    sets = table_of(_full_sets(texts, width).dropDuplicates(["v"]), "sets")  # a repeated row brings its set again

    # a set may have many partners and be in many lists: what carries sets is moved in rounds, each written before the next
    bytes_of_sets = sets.agg(F.sum(F.octet_length("set"))).first()[0]
    rounds = _rounds(pairs.agg(F.sum(8 * F.col("n_a"))).first()[0], bytes_of_sets)
    turn = lambda df, k, *key: df.where(F.pmod(F.xxhash64(*key), F.lit(rounds)) == k) if rounds > 1 else df
    links = reduce(DataFrame.union, [table_of(_confirm(turn(pairs, k, "a", "b"), sets, num, den), "links") for k in range(rounds)])
    comps = table_of(connected_components(links), "found")

    # long lists with several components: an exact search across components
    own = long_lists.join(doubtful, "v").select("value", "v", "n")
    own = table_of(own.join(comps, F.col("v") == F.col("vertex"), "left").select("value", "v", "n", F.coalesce("component", "v").alias("component")), "long-lists")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(8 * F.sum("n") / BLOCK_BYTES)).cast("int")
    mixed = own.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), blocks.alias("blocks")).where("lo != hi").select("value", "blocks")
    dealt = own.join(mixed, "value").withColumn("blk", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    # a document goes to each pair of its block with another, and to its block alone
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"x": F.least("blk", "o"), "y": F.greatest("blk", "o"), "side": (F.col("blk") > F.col("o")).cast("int")})
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rounds = _rounds(own.join(mixed, "value").agg(F.sum(8 * F.col("n") * F.col("blocks"))).first()[0], bytes_of_sets)
    lists_of = lambda k: turn(dealt, k, "value", "x", "y").join(sets, "v").repartition(parts, "value", "x", "y").sortWithinPartitions("value", "x", "y")
    more = reduce(DataFrame.union, [table_of(_search_lists(lists_of(k), num, den), "more-links") for k in range(rounds)])
    comps = materialize(connected_components(links.union(more)), "components")
    for done in scratch:
        drop_scratch(done)

    named = reps.select("v", "set_key", "doc_id").join(comps, F.col("v") == F.col("vertex"), "left").select("set_key", "doc_id", F.coalesce("component", "v").alias("c"))
    ids = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    by_set = named.select("set_key", "c").join(ids, "c").select("set_key", "component_id")
    out = rows.select("doc_id", "n", "set_key").join(by_set, "set_key", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("doc_id", id_col)


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one row of each component, that of the least doc_id; of rows that repeat an id and a text, one.

    All columns stay, whatever their names.  Null, empty and blank texts are components of their own.
    """
    ids = near_duplicates(docs, width, num, den).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    some = rows.join(ids, F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    return some.dropDuplicates(["id", "key"]).select("row.*")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 85, 100)


QUERIES = {"op2_minhash_near_dedup": op2_minhash_near_dedup}
SQL: dict[str, str] = {}
