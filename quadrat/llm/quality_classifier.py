"""A quality classifier: random-indexing word vectors, pooled, and a two-layer network in numpy.

Random indexing: a word, and the shape of a word (its case and the symbols in it), has a sparse ternary
index vector that follows from its hash.  A word's context vector adds up the index vectors of its
neighbours over all documents; its vector is the index vector plus the direction of the context vector.
Context vectors are kept for the most frequent words of the corpus, ``VOCABULARY`` of them at most, which
is the size of the model; any other word, and a shape, has its index vector alone.  A text pools the
vectors of all its words: their mean, the spread around it, and how its words repeat.

Each partition adds up its own context vectors; they are added together in rounds, so many at a time,
until there is one sum for each block of words.  The network (tanh, then logistic) is fitted on a bounded
sample of labelled rows; a part of it set aside calibrates the temperature.  ``max_labelled`` is the
bound: the ids of the smallest hash, with one text each, of any length.  Texts are pooled where they are;
only their pooled vectors reach the driver.  All rows are scored, whole texts.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import arrow_batches, byte_slices, crc_bucket, drop_scratch, materialize, table
from quadrat.llm.worker import give_back, state

MAX_LABELLED = 3000
DIM, NONZERO, HIDDEN = 64, 6, 24
THRESHOLD = 0.3
VOCABULARY, REACH = 20_000, 2
#: Words in a block of sums, sums that are added up in one task, and distinct words that a task holds when it counts.
BLOCK, FAN_IN, HELD_WORDS = 1000, 32, 500_000
_SHAPE = bytes(ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256))


def hashes(features: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, features), np.uint64, len(features))


def index_sum(h: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted sum of the index vectors of some hashes: seven bits each for the place and sign of a component."""
    out = np.zeros(DIM)
    for k in range(NONZERO):
        bits = h >> np.uint64(7 * k)
        sign = 1.0 - 2.0 * (bits >> np.uint64(6) & np.uint64(1)).astype(np.float64)
        out += np.bincount((bits & np.uint64(DIM - 1)).astype(np.int64), weights=weights * sign, minlength=DIM)
    return out / np.sqrt(NONZERO)


def index_matrix(features: list[bytes]) -> np.ndarray:
    h = hashes(features)
    return np.stack([index_sum(h[i : i + 1], np.ones(1)) for i in range(len(h))]) if features else np.zeros((0, DIM))


def shape(word: bytes) -> bytes:
    """Runs of the same kind of character as one: b"THE!!" to b"A!"."""
    s = word.translate(_SHAPE)
    return bytes(c for i, c in enumerate(s) if not i or s[i - 1] != c)[:8]


class Vectors:
    """Vectors of words: those learned have a row; of the others the index vectors are summed as they are."""

    def __init__(self, context: dict[bytes, np.ndarray] | None = None) -> None:
        self.context = context or {}
        self.rows = {w: i for i, w in enumerate(self.context)}
        self.matrix = index_matrix(list(self.rows)) + (np.stack(list(self.context.values())) if self.context else 0)
        self.shapes: dict[bytes, bytes] = {}

    def pool(self, text: str | None) -> np.ndarray:
        """The pooled vector of a text; zeros for one without words."""
        raw = (text or "").encode()
        words = Counter(raw.lower().split())
        out = np.zeros(2 * DIM + 4)
        n = sum(words.values())
        if not n:
            return out
        get = self.rows.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        share = np.fromiter(words.values(), np.float64, len(words)) / n
        known = at >= 0
        out[:DIM] = share[known] @ self.matrix[at[known]] if known.any() else 0
        if not known.all():
            out[:DIM] += index_sum(hashes([w for w in words if get(w, -1) < 0]), share[~known])
        kinds: Counter = Counter()
        if len(self.shapes) > 100_000:
            self.shapes.clear()
        for w, k in Counter(raw.translate(_SHAPE).split()).items():
            s = self.shapes.get(w)
            if s is None:
                s = self.shapes[w] = b"\0" + shape(w)
            kinds[s] += k
        out[DIM : 2 * DIM] = index_sum(hashes(list(kinds)), np.fromiter(kinds.values(), np.float64, len(kinds)) / n)
        out[2 * DIM :] = np.log1p(n) / 10, len(words) / n, np.sqrt((share * share).sum()), np.linalg.norm(out[:DIM])
        return out


def _words(texts: pa.Array) -> pa.ListArray:
    """The words of each text, A-Z in lower case; empty strings may be among them."""
    return pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))


def frequent_words(docs: DataFrame, most: int = VOCABULARY) -> list[str]:
    """The words of docs (text) above some count, at most so many, by their counts.

    A histogram of logarithms of counts gives the count, so no more words than that reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for b in byte_slices(batches, 0):
            found = _words(b.column(0)).flatten().value_counts()
            for w, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                counts[w] += n
            if len(counts) > HELD_WORDS:
                yield out()
        yield out()
        give_back()

    counted = docs.select("text").mapInArrow(run, "word string, n long").where("word != '' AND octet_length(word) <= 256")
    with arrow_batches(docs.sparkSession):
        words = materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    level = F.floor(16 * F.log2("n"))
    cut, total = None, 0
    for r in sorted(words.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):  # some hundred rows
        total += r["count"]
        if total > most:
            break
        cut = r["level"]
    got = [] if cut is None else words.where(level >= cut).collect()
    drop_scratch(words)
    return [r["word"] for r in sorted(got, key=lambda r: (-r["n"], r["word"]))]


def index_parts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The places and signs of the NONZERO components of each word's index vector."""
    h = hashes([w.encode() for w in words])
    bits = np.stack([h >> np.uint64(7 * k) for k in range(NONZERO)], axis=1)
    return (bits & np.uint64(DIM - 1)).astype(np.int64), 1.0 - 2.0 * (bits >> np.uint64(6) & np.uint64(1)).astype(np.float64)


def context_sums(texts: pa.Array, words: pa.Array, places: np.ndarray, signs: np.ndarray, sums: np.ndarray) -> None:
    """Add to sums, a row for each of words, the index vectors of the words up to REACH before and after it."""
    split = _words(texts)
    flat = split.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    at = pc.fill_null(pc.index_in(flat, value_set=words), -1).to_numpy(zero_copy_only=False)[real].astype(np.int64)
    text = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))[real]
    cells = sums.ravel()
    for d in range(1, REACH + 1):
        a, b = at[:-d], at[d:]
        both = (a >= 0) & (b >= 0) & (text[:-d] == text[d:])
        pair, n = np.unique(a[both] * len(words) + b[both], return_counts=True)
        x, y = pair // len(words), pair % len(words)
        for own, other in ((x, y), (y, x)):
            for k in range(NONZERO):
                np.add.at(cells, own * DIM + places[other, k], n * signs[other, k])


def learn_vectors(docs: DataFrame, most: int = VOCABULARY) -> dict[bytes, np.ndarray]:
    """Context vectors of the most frequent words, from all rows of docs (text)."""
    words = frequent_words(docs, most)
    if not words:
        return {}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)  # at most `most` words of 256 bytes

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, (places, signs) = pa.array(shared.value, pa.string()), index_parts(shared.value)
        sums = np.zeros((len(known), DIM))
        for b in byte_slices(batches, 0):
            context_sums(b.column(0), known, places, signs, sums)
        parts = [sums[i : i + BLOCK].astype("<f8").tobytes() for i in range(0, len(sums), BLOCK)]
        columns = [[TaskContext.get().partitionId()] * len(parts), range(len(parts)), [pa.compress(x, "zstd", asbytes=True) for x in parts], map(len, parts)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)], names=["part", "block", "sums", "size"])
        give_back()

    def merge(rows: pa.Table) -> pa.Table:
        size = rows.column("size")[0].as_py()
        total = np.zeros(size // 8)
        for x in rows.column("sums").to_pylist():
            total += np.frombuffer(pa.decompress(x, size, "zstd", asbytes=True), "<f8")
        one = rows.slice(0, 1)
        return pa.table({"part": one.column("part"), "block": one.column("block"), "sums": pa.array([pa.compress(total.tobytes(), "zstd", asbytes=True)], pa.binary()), "size": one.column("size")})

    kind = "part long, block long, sums binary, size long"
    with arrow_batches(spark):
        sums = materialize(docs.select("text").mapInArrow(add, kind), "context-sums")
        parts = sums.agg(F.max("part")).first()[0] or 0
        while parts:
            parts //= FAN_IN
            last, sums = sums, materialize(sums.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "block").applyInArrow(merge, kind), "context-sums")
            drop_scratch(last)
    got = sorted(sums.collect(), key=lambda r: r["block"])  # DIM numbers for each word of the vocabulary
    drop_scratch(sums)
    total = np.concatenate([np.frombuffer(pa.decompress(bytes(r["sums"]), r["size"], "zstd", asbytes=True), "<f8") for r in got]).reshape(-1, DIM)
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    total = (total / np.where(norm > 0, norm, 1)).astype(np.float32)
    return {w.encode(): total[i] for i, w in enumerate(words)}


class Network:
    """standardised inputs -> tanh -> logit; probabilities are calibrated by one temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, rounds: int = 300, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.sd = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = self._scale(x)
        self.p = [rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden), rng.standard_normal(hidden) / np.sqrt(hidden), np.zeros(1)]
        self.temperature = 1.0
        aside = np.arange(len(y)) % 5 == 4
        if not len(y) or y.min() == y.max():  # one kind of label only: its share, a little drawn to the middle
            self.p[2][:] = 0
            self.p[3][0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
            return
        self._train(x[~aside], y[~aside], rounds, rng)
        z, t = self._logits(x[aside]), y[aside]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, np.where(t > 0, -z, z) / g).mean() for g in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _scale(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.sd).clip(-6, 6)

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def _train(self, x: np.ndarray, y: np.ndarray, rounds: int, rng, rate: float = 0.01, decay: float = 1e-3) -> None:
        m, v = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        t = 0
        weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) ** 0.5
        for _ in range(max(1, rounds * 64 // max(64, len(y) // 4))):
            order = rng.permutation(len(y))
            for at in range(0, len(y), 64):
                i = order[at : at + 64]
                h = np.tanh(x[i] @ self.p[0] + self.p[1])
                z = h @ self.p[2] + self.p[3][0]
                d = (1 / (1 + np.exp(-z)) - y[i]) * weight[i] / len(i)
                dh = np.outer(d, self.p[2]) * (1 - h * h)
                grads = [x[i].T @ dh + decay * self.p[0], dh.sum(axis=0), h.T @ d + decay * self.p[2], np.array([d.sum()])]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self._logits(self._scale(x)) / self.temperature))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[dict[bytes, np.ndarray], Network]:
    """(context vectors, network) from docs (doc_id, text) and labels (doc_id, quality); held-out rows must not be in labels.

    Labels without an id or a quality are not used; of labels that repeat an id the least counts, and
    of documents that repeat it the one of the least text, null texts left out.  Without labelled rows,
    or with one kind of label only, every text has the same score.  An empty table teaches nothing.
    """
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_label"))
    chosen = own.orderBy(F.xxhash64("_id", F.lit(4)), "_id").limit(max_labelled)
    context = learn_vectors(docs.select("text"))
    shared = docs.sparkSession.sparkContext.broadcast(context)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(shared.value)
        for b in byte_slices(batches, 2):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([vectors.pool(t) for t in b.column(2).to_pylist()], pa.list_(pa.float64()))], names=["id", "label", "x"])

    some = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    some = some.groupBy("_id").agg(F.min("_label").cast("int").alias("_label"), F.min("text").alias("text"))
    with arrow_batches(docs.sparkSession):
        got = some.select(F.col("_id").cast("long"), "_label", "text").mapInArrow(pooled, "id long, label int, x array<double>").collect()  # max_labelled rows
    got.sort(key=lambda r: r["id"])
    x = np.array([r["x"] for r in got]) if got else np.zeros((1, 2 * DIM + 4))
    return context, Network(x, np.array([r["label"] for r in got], np.float64) if got else np.array([0.5]))


def probability(docs: DataFrame, model: tuple[dict[bytes, np.ndarray], Network], text: Column) -> Column:
    """The probability of label 1 for a text of docs.

    A null text is empty, and all texts without a word have one and the same score.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)
    key = f"{sc.applicationId}-{uuid.uuid4().hex}"

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors = state(key, lambda: Vectors(shared.value[0]))
        for texts in batches:
            x = np.stack([vectors.pool(t) for t in texts]) if len(texts) else np.zeros((0, 2 * DIM + 4))
            yield pd.Series(shared.value[1].probability(x))

    return scored(text)


def score(docs: DataFrame, model: tuple[dict[bytes, np.ndarray], Network], text_col: str = "text", out: str = "_score") -> DataFrame:
    """docs with one more column, by default ``_score``; a column of docs of that name is an error, not overwritten."""
    if out.lower() in map(str.lower, docs.columns):
        raise ValueError(f"there is a column {out}")
    return docs.withColumn(out, probability(docs, model, F.col(f"`{text_col}`")))


def train_rows(labels: DataFrame, modulus: int = 5) -> DataFrame:
    return labels.where(crc_bucket(F.col("doc_id"), modulus) != 0)


def keep_above(docs: DataFrame, model: tuple[dict[bytes, np.ndarray], Network], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with their columns, whatever their names, that score the threshold or more."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("own"))
    return row.withColumn("score", probability(row, model, F.col("own"))).where(F.col("score") >= threshold).select("row.*")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, train_rows(table(spark, sf_dir, "labels"))))
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op4_quality_classifier": op4_quality_classifier}
SQL: dict[str, str] = {}
