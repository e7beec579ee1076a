"""Language-model scores by online logistic context mixing, beside a word unigram.

The model predicts the bits of a text's UTF-8 bytes and of a final zero byte.  For each order of
context (the last 1 to 5 bytes) zeros and ones have been counted after the context and the bits of the
byte so far; the counts give a probability and a confidence.  A mixer adds the stretched probabilities
with weights that a gate picks (by bit and by the confidence of two orders), and an adaptive table
refines what comes out.  The bits add up to the score.

Learning goes over all training rows.  A byte's bits depend on the window of six bytes that ends with
it only, so the windows of each partition are counted and dealt to shards by the two bytes before the
last: a shard has every count of its contexts of orders 2 to 5, under the contexts themselves, so no
two contexts share a count.  Order 1 has 65,536 counts, which are broadcast.  There are as many shards
as the training bytes ask for; nothing but order 1 and the mixer is ever in one place.  The mixer
learns from the windows of each shard, each with counts that leave one occurrence of it out, and
weights and refinement counts are averaged over the shards by their bits.

Scoring sends the distinct windows of chunks of documents to the shards and adds up the costs that
come back for each document of a chunk.

Word counts of the ``HEAD`` most frequent words of up to 64 bytes are broadcast (bounded by 8 MB);
rarer words of a text leave the pass as rows and meet their counts in an equi-join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import arrow_batches, byte_slices, crc_bucket, drop_scratch, materialize, table
from quadrat.llm.worker import give_back

HEAD, HEAD_BYTES = 100_000, 64
ORDERS = 5
#: Training bytes that ask for a shard, text bytes of a chunk that is scored together, and windows in a row of a table.
SHARD_BYTES, CHUNK_BYTES, CUT = 8 << 20, 8 << 20, 20_000
#: Distinct windows, and distinct words, that a task holds before it hands on what it has counted.
HELD_WINDOWS, HELD_WORDS = 1_500_000, 500_000
#: Slots of order 1: a byte, and the bits so far of the next.
FIRST = 1 << 16
GATES, CELLS = 8 * 4 * 4, 33
COST_BITS = 19
END = b"\n"  # stands for the end token: no word holds a line feed
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Six bytes up to and with each byte of the texts (and a final zero) as numbers, and where each text begins and ends."""
    buf = np.frombuffer(b"".join([b"\0\0\0\0\0" + t + b"\0" for t in texts]), np.uint8)
    if not len(buf):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    a = buf.astype(np.uint64)
    w2 = a[:-1] << np.uint64(8) | a[1:]
    w4 = w2[:-2] << np.uint64(16) | w2[2:]
    w6 = w4[:-2] << np.uint64(16) | w2[4:]
    sizes = np.array([len(t) + 6 for t in texts])
    ends = np.cumsum(sizes) - 5  # window i ends at byte i + 5
    return w6, ends - sizes + 5, ends


def counted_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of the texts and how often each occurs."""
    w, starts, ends = windows(texts)
    if not len(w):
        return w, np.empty(0, np.int64)
    inside = np.zeros(len(w) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    w = np.sort(w[np.cumsum(inside[:-1]) > 0])
    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    return w[first], np.diff(np.append(first, len(w)))


def merge_counts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    w, n = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(w, kind="stable")
    w, n = w[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.empty(0, np.int64)
    return w[first], (np.add.reduceat(n, first) if len(first) else n)


def first_slot(w: np.ndarray, bit: int) -> np.ndarray:
    """The slot of order 1."""
    byte = w & np.uint64(255)
    return (w & np.uint64(0xFF00) | np.uint64(1 << bit) | byte >> np.uint64(8 - bit)).astype(np.int64)


def by_shard(w: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of windows of it), at most CUT at a time."""
    with np.errstate(over="ignore"):
        shard = ((w >> np.uint64(8) & np.uint64(0xFFFF)) * _MIX[0] >> np.uint64(40)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
    for i in np.flatnonzero(np.diff(bounds)):
        for at in range(bounds[i], bounds[i + 1], CUT):
            yield int(i), order[at : min(at + CUT, bounds[i + 1])]


def pack(a: np.ndarray) -> bytes:
    """Numbers as bytes, compressed place by place: sorted windows of a shard have much in common."""
    return len(a).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes(), "zstd", asbytes=True)


def unpack(b: bytes, dtype) -> np.ndarray:
    n, size = int.from_bytes(b[:8], "little"), np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(pa.decompress(b[8:], n * size, "zstd", asbytes=True), np.uint8).reshape(size, n).T).view(dtype).ravel()


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *[unpack(b, dtype) for b in column.to_pylist()]])


def _training_windows(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    none = counted_windows([])
    return merge_counts(none, (_joined(rows.column("windows"), np.uint64), _joined(rows.column("counts"), np.int32).astype(np.int64)))


class Contexts:
    """What has been counted after each context of a shard: counts of (context, byte), sorted by them and added up from below."""

    def __init__(self, first: tuple[np.ndarray, np.ndarray], w: np.ndarray, n: np.ndarray) -> None:
        """Of distinct sorted windows and their counts; first has zeros and ones of the slots of order 1."""
        self.first, self.keys, self.below = first, [], []
        for k in range(2, ORDERS + 1):
            key, c = (w, n) if k == ORDERS else merge_counts((w & self._mask(k), n), counted_windows([]))
            self.keys.append(key)
            self.below.append(np.concatenate([[0], np.cumsum(c)]))

    @staticmethod
    def _mask(k: int) -> np.uint64:
        return np.uint64((1 << 8 * (k + 1)) - 1)

    def each(self, w: np.ndarray, own: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(a row of inputs for each window, its gate) of bit 0, 1, ..., with counts from which the window itself is taken own times."""
        context = [w & self._mask(k) & ~np.uint64(255) for k in range(2, ORDERS + 1)]
        lo = [np.searchsorted(keys, c) for keys, c in zip(self.keys, context, strict=True)]
        hi = [np.searchsorted(keys, c | np.uint64(255), "right") for keys, c in zip(self.keys, context, strict=True)]
        for bit in range(8):
            one = (w >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
            half = np.uint64(128 >> bit)
            middle = w & np.uint64(255) & ~(half * np.uint64(2) - np.uint64(1)) | half
            x, seen = np.empty((len(w), ORDERS + 1), np.float32), []
            for k in range(ORDERS):
                if k == 0:
                    at = first_slot(w, bit)
                    n0, n1 = self.first[0][at], self.first[1][at]
                else:
                    keys, below = self.keys[k - 1], self.below[k - 1]
                    mid = np.searchsorted(keys, context[k - 1] | middle)
                    n0, n1 = below[mid] - below[lo[k - 1]], below[hi[k - 1]] - below[mid]
                    lo[k - 1], hi[k - 1] = np.where(one, mid, lo[k - 1]), np.where(one, hi[k - 1], mid)
                if own:
                    n0, n1 = n0 - own * ~one, n1 - own * one
                x[:, k] = np.log((n1 + 0.05) / (n0 + 0.05)).clip(-12, 12)
                seen.append(n0 + n1)
            x[:, ORDERS] = 0.3
            yield x, (bit * 4 + np.digitize(seen[4], [1, 8, 128])) * 4 + np.digitize(seen[2], [1, 8, 128])


class Mixer:
    """Gated weights and the table that refines the mix."""

    def __init__(self, weights: np.ndarray | None = None, seen: np.ndarray | None = None, ones: np.ndarray | None = None) -> None:
        self.weights = np.full((GATES, ORDERS + 1), 0.25, np.float32) if weights is None else weights
        self.seen = np.zeros(8 * CELLS) if seen is None else seen
        self.ones = np.zeros(8 * CELLS) if ones is None else ones

    def _cell(self, dot: np.ndarray, bit: int) -> np.ndarray:
        return bit * CELLS + np.rint((dot.clip(-8, 8) + 8) * ((CELLS - 1) / 16)).astype(np.int64)

    def mix(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", x, self.weights[gate]).clip(-12, 12)

    def learn(self, x: np.ndarray, gate: np.ndarray, one: np.ndarray, n: np.ndarray, bit: int, rate: float) -> None:
        """A step over some bits, each seen n times."""
        dot = self.mix(x, gate)
        error = (one - 1 / (1 + np.exp(-dot))) * n
        total = np.bincount(gate, weights=n, minlength=GATES)
        for k in range(ORDERS + 1):
            step = np.bincount(gate, weights=error * x[:, k], minlength=GATES)
            self.weights[:, k] += (rate * step / np.maximum(total, 1)).astype(np.float32)
        cell = self._cell(dot, bit)
        np.add.at(self.seen, cell, n)
        np.add.at(self.ones, cell, n * one)

    def probability(self, x: np.ndarray, gate: np.ndarray, bit: int) -> np.ndarray:
        """Of a one: the mean of the mix and of what followed such a mix in learning."""
        dot = self.mix(x, gate)
        p = 1 / (1 + np.exp(-dot.astype(np.float64)))
        cell = self._cell(dot, bit)
        refined = (self.ones[cell] + 32 * p) / (self.seen[cell] + 32)
        return ((p + refined) / 2).clip(1e-6, 1 - 1e-6)


class Costs:
    """log10 of the probability of the last byte of windows."""

    def __init__(self, contexts: Contexts, mixer: Mixer) -> None:
        self.contexts, self.mixer = contexts, mixer

    def compute(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(w))
        for at in range(0, len(w), 65536):
            part = w[at : at + 65536]
            for bit, (x, gate) in enumerate(self.contexts.each(part)):
                p = self.mixer.probability(x, gate, bit)
                one = (part >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
                out[at : at + 65536] += np.log10(np.where(one, p, 1 - p))
        return out


class Known:
    """Costs that are known for every window that is asked for; what was asked for lately is found by its hash."""

    def __init__(self, w: np.ndarray, costs: np.ndarray) -> None:
        order = np.argsort(w)
        self.known, self.found = w[order], costs[order]
        self.keys = np.full(1 << COST_BITS, np.uint64(2**64 - 1))
        self.costs = np.zeros(1 << COST_BITS, np.float32)

    def _lookup(self, w: np.ndarray) -> np.ndarray:
        """NaN for windows across the end of a text, which nobody asks for."""
        at = np.searchsorted(self.known, w).clip(max=max(len(self.known) - 1, 0))
        return np.where(self.known[at] == w, self.found[at], np.nan) if len(self.known) else np.full(len(w), np.nan)

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """log10 of the probability of each text."""
        w, starts, ends = windows(texts)
        if not len(w):
            return np.zeros(len(texts))
        with np.errstate(over="ignore"):
            at = ((w * _MIX[2]) >> np.uint64(64 - COST_BITS)).astype(np.int64)
        cost = self.costs[at].astype(np.float64)
        miss = np.flatnonzero(self.keys[at] != w)
        if len(miss):
            new, back = np.unique(w[miss], return_inverse=True)
            made = self._lookup(new).astype(np.float32)  # as kept, so that a score does not depend on what came before
            cost[miss] = made[back]
            with np.errstate(over="ignore"):
                at = ((new * _MIX[2]) >> np.uint64(64 - COST_BITS)).astype(np.int64)
            self.keys[at], self.costs[at] = new, made
        return np.array([cost[a:b].sum() for a, b in zip(starts, ends, strict=True)])


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [(t or "").encode() for t in batch.column(column).to_pylist()]


def _count(texts: DataFrame, shards: int) -> DataFrame:
    """(word, n), (slot, n, ones) of order 1 and (shard, windows, counts) of a table of training texts, as rows of one table; added up within a partition only."""
    fields = [("word", pa.binary()), ("slot", pa.int32()), ("n", pa.int64()), ("ones", pa.int64()), ("shard", pa.int32()), ("windows", pa.binary()), ("counts", pa.binary())]

    def batch(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in fields], names=[k for k, _ in fields])

    def rows(words: Counter, bits: list) -> Iterator[pa.RecordBatch]:
        if words:
            yield batch(len(words), word=list(words), n=list(words.values()))
        w, n = bits
        if len(w):
            zeros, ones = np.zeros(FIRST, np.int64), np.zeros(FIRST, np.int64)
            for bit in range(8):
                one = (w >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
                at = first_slot(w, bit)
                np.add.at(ones, at[one], n[one])
                np.add.at(zeros, at[~one], n[~one])
            used = np.flatnonzero(zeros + ones)
            yield batch(len(used), slot=used, n=(zeros + ones)[used], ones=ones[used])
            for shard, at in by_shard(w, shards):
                yield batch(1, shard=[shard], windows=[pack(w[at])], counts=[pack(n[at].astype(np.int32))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits = Counter(), counted_windows([])
        for b in byte_slices(batches, 0, 1000, 1 << 20):
            texts = _texts(b, 0)
            for t in texts:
                words.update(t.translate(_LOWER).split())
            words[END] += len(texts)
            bits = merge_counts(bits, counted_windows(texts))
            if len(words) > HELD_WORDS or len(bits[0]) > HELD_WINDOWS:
                yield from rows(words, bits)
                words, bits = Counter(), counted_windows([])
        yield from rows(words, bits)
        words.clear()
        give_back()

    return texts.select("text").mapInArrow(run, "word binary, slot int, n long, ones long, shard int, windows binary, counts binary")


def _mix(windows: DataFrame, first, rate: float = 0.02, step: int = 2048, block: int = 65536) -> DataFrame:
    """(what, at, n, sum): weights times their bits ("w") and refinement counts ("r"), of each shard of training windows."""

    def run(rows: pa.Table) -> pa.Table:
        mixer, total = Mixer(), np.zeros(GATES)
        w, n = _training_windows(rows)
        own = Contexts(first.value, w, n)
        order = np.random.default_rng(len(w)).permutation(len(w))
        for at in range(0, len(w), block):
            part, times = w[order[at : at + block]], n[order[at : at + block]].astype(np.float64)
            for bit, (x, gate) in enumerate(own.each(part, 1)):
                one = (part >> np.uint64(7 - bit) & np.uint64(1)).astype(np.float64)
                for i in range(0, len(part), step):
                    j = slice(i, i + step)
                    mixer.learn(x[j], gate[j], one[j], times[j], bit, rate)
                total += np.bincount(gate, weights=times, minlength=GATES)
        del own, w, n
        give_back()
        what = ["w"] * mixer.weights.size + ["r"] * len(mixer.seen)
        each = np.repeat(total, ORDERS + 1)
        return pa.table({"what": what, "at": pa.array([*range(mixer.weights.size), *range(len(mixer.seen))], pa.int32()), "n": np.concatenate([each, mixer.seen]), "sum": np.concatenate([mixer.weights.ravel() * each, mixer.ones])})

    return windows.groupBy("shard").applyInArrow(run, "what string, at int, n double, sum double")


class Model:
    """A fitted model: counts of words as a table, and what a worker needs to score."""

    def __init__(self, docs: DataFrame, head: int = HEAD) -> None:
        """Learn from docs (a column text; null is empty), all rows."""
        with arrow_batches(docs.sparkSession):
            self._learn(docs, head)

    def _learn(self, docs: DataFrame, head: int) -> None:
        sc = docs.sparkSession.sparkContext
        self.shards = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES
        counted = materialize(_count(docs, self.shards), "lm-counts")
        self.windows = counted.where(F.col("shard").isNotNull()).select("shard", "windows", "counts")
        self.words = materialize(counted.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
        total = self.words.agg(F.sum("c"), F.count("*")).first()
        self.tokens, self.distinct = total[0] or 0, total[1]
        got = counted.where(F.col("slot").isNotNull()).groupBy("slot").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).toArrow()
        slot, n, ones = (got.column(k).to_numpy() for k in ("slot", "n", "ones"))
        first = np.zeros(FIRST, np.int64), np.zeros(FIRST, np.int64)
        first[0][slot], first[1][slot] = n - ones, ones
        self.first = sc.broadcast(first)
        weights, seen, hits = Mixer().weights, np.zeros(8 * CELLS), np.zeros(8 * CELLS)
        for r in _mix(self.windows, self.first).groupBy("what", "at").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).collect():  # as many as weights and cells
            if r["what"] == "r":
                seen[r["at"]], hits[r["at"]] = r["n"], r["sum"]
            elif r["n"]:
                weights.flat[r["at"]] = r["sum"] / r["n"]
        self.head = sc.broadcast({bytes(r["word"]): r["c"] for r in self._frequent(head).collect()})  # at most head rows
        self.mixer = sc.broadcast(Mixer(weights, seen, hits))

    def _frequent(self, most: int) -> DataFrame:
        """The words above some count, at most so many: a histogram of logarithms of counts, of some hundred rows, gives the count."""
        level = F.floor(16 * F.log2("c"))
        short = self.words.where(F.length("word") <= HEAD_BYTES)
        cut, total = None, 0
        for r in sorted(short.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
            total += r["count"]
            if total > most:
                break
            cut = r["level"]
        return short.where(F.lit(False) if cut is None else level >= cut)


def _written(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _ask(docs: DataFrame, model: Model) -> DataFrame:
    """(chunk, docs): slices of docs (doc_id, text), counted in words, as compressed batches; (chunk, shard, windows): the distinct windows of each chunk."""
    head, shards, below = model.head, model.shards, model.tokens + 0.1 * (model.distinct + 1)
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
    fields = [("chunk", pa.int64()), ("docs", pa.binary()), ("shard", pa.int32()), ("windows", pa.binary())]

    def batch(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in fields], names=[k for k, _ in fields])

    def asked(chunk: int, new: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        w = np.unique(np.concatenate(new))
        for shard, at in by_shard(w, shards):
            yield batch(1, chunk=[chunk], shard=[shard], windows=[pack(w[at])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        logs = {w: math.log10((c + 0.1) / below) for w, c in head.value.items()}
        get, end = logs.get, logs.get(END)
        chunk, size, new = TaskContext.get().partitionId() << 32, 0, []
        recent = np.full(1 << COST_BITS, np.uint64(2**64 - 1))
        for b in byte_slices(batches, 1, 1000, 1 << 20):
            texts = _texts(b, 1)
            tokens, known, base, rare = [], [], [], []
            for t in texts:
                ws = t.translate(_LOWER).split()
                found = list(map(get, ws))
                tail = Counter([w for w, x in zip(ws, found, strict=True) if x is None])
                if end is None:
                    tail[END] += 1
                tokens.append(len(ws) + 1)
                known.append(len(ws) + 1 - sum(tail.values()))
                base.append(math.fsum(x for x in found if x is not None) + (end or 0.0))
                rare.append([{"word": w, "n": n} for w, n in tail.items()])
            own = [b.column(0), pa.array([len(t) + 1 for t in texts], pa.int64()), b.column(1), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(rare, rare_type)]
            yield batch(1, chunk=[chunk], docs=[_written(pa.RecordBatch.from_arrays(own, names=["doc_id", "n_bytes", "text", "n_tokens", "known", "base", "rare"]))])
            w, starts, ends = windows(texts)
            inside = np.zeros(len(w) + 1, np.int8)
            np.add.at(inside, starts, 1)
            np.add.at(inside, ends, -1)
            w = w[np.cumsum(inside[:-1]) > 0]
            with np.errstate(over="ignore"):
                at = ((w * _MIX[2]) >> np.uint64(64 - COST_BITS)).astype(np.int64)
            miss = recent[at] != w
            recent[at[miss]] = w[miss]
            new.append(np.unique(w[miss]))
            size += sum(map(len, texts))
            if size > CHUNK_BYTES:
                yield from asked(chunk, new)
                chunk, size, new = chunk + 1, 0, []
                recent[:] = np.uint64(2**64 - 1)
        if new:
            yield from asked(chunk, new)
        new.clear()
        logs.clear()
        give_back()

    return docs.mapInArrow(run, "chunk long, docs binary, shard int, windows binary")


def _priced(asked: DataFrame, model: Model) -> DataFrame:
    """(chunk, windows, costs) of what chunks ask for."""
    first, mixer = model.first, model.mixer

    def run(train: pa.Table, rows: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "windows": pa.array([], pa.binary()), "costs": pa.array([], pa.binary())})
        every = np.unique(_joined(rows.column("windows"), np.uint64))
        costs = Costs(Contexts(first.value, *_training_windows(train)), mixer.value).compute(every).astype(np.float32)
        found = [pack(costs[np.searchsorted(every, unpack(b, np.uint64))]) for b in rows.column("windows").to_pylist()]
        give_back()
        return pa.table({"chunk": rows.column("chunk"), "windows": rows.column("windows"), "costs": pa.array(found, pa.binary())})

    return model.windows.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(run, "chunk long, windows binary, costs binary")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, bits_per_byte) of every row.

    A null text is empty: one token, and the final zero byte.  bits_per_byte counts that byte too.
    Repeated rows are scored one by one; a null id stays null; other columns are not looked at.
    """
    below = model.tokens + 0.1 * (model.distinct + 1)
    kept = ["doc_id", "n_bytes", "n_tokens", "known", "base", "rare"]

    def add_up(rows: pa.Table, costs: pa.Table) -> pa.Table:
        own = Known(_joined(costs.column("windows"), np.uint64), _joined(costs.column("costs"), np.float32))
        out = []
        for blob in rows.column("docs").to_pylist():
            part = pa.ipc.open_stream(blob).read_all()
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            out.append(part.select(kept).append_column("score", pa.array(own.texts(texts), pa.float64())))
        del own
        give_back()
        return pa.concat_tables(out)

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    with arrow_batches(docs.sparkSession):
        asked = materialize(_ask(own, model), "lm-asked")
    costs = _priced(asked.where(F.col("shard").isNotNull()).select("shard", "chunk", "windows"), model)
    rows = asked.where(F.col("docs").isNotNull()).select("chunk", "docs").groupBy("chunk").cogroup(costs.groupBy("chunk"))
    rows = rows.applyInArrow(add_up, "doc_id long, n_bytes long, n_tokens long, known long, base double, rare array<struct<word:binary,n:long>>, score double")
    rows = materialize(rows.withColumn("_uid", F.monotonically_increasing_id()), "lm-scored")
    drop_scratch(asked)
    rare = rows.select("_uid", F.inline("rare")).join(model.words, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rare = rare.groupBy("_uid").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * F.log10((c + 0.1) / F.lit(below))).alias("rest"))
    return rows.drop("rare").join(rare, "_uid", "left").select(
        F.col("doc_id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score", (F.col("score") / (-math.log10(2) * F.col("n_bytes"))).alias("bits_per_byte"),
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 10) == 0
    model = Model(docs.where(~held_out))
    out = score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")


QUERIES = {"op6_lm_score": op6_lm_score}
SQL: dict[str, str] = {}
