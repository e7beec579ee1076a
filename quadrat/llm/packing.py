"""Packing of tokenized documents into sequences of bounded length.

Texts are tokenized in Arrow batches.  Packing works on the *counts* of piece lengths, of which there
are at most ``capacity``, whatever the number of documents: the driver never sees a document.

1.  Martello-Toth reduction: for each length, from the longest, a small set that provably dominates
    every other set with such a piece in it is fixed for good, and the instance shrinks, until no
    length has such a set.  Dominance used: a piece
    with which nothing fits stays alone; an exact complement; the largest partner where only one more
    piece fits; the largest partner where two more fit, but no such pair is larger than it.
2.  Best-fit decreasing packs the rest.  Pieces of one length are placed together, group of bins by
    group of bins with equal free space, which gives what placing them one by one gives.

The plan is a list of runs: ranks a..b of length s go to bins from q on.  Pieces get their rank within
their length by counts of chunks and a row number in each chunk, and meet their run in an equi-join on
(length, block of ranks), so that a length that a third of all pieces have is spread over many keys.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrat.llm.common import byte_slices, materialize, table
from quadrat.llm.worker import Generations, state

CAPACITY = 4096
END_ID = 1
#: Bytes of tokenized pieces that a Python worker keeps.
CACHE = 96 << 20
RANK_BLOCK = 256
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: Kinds of bytes in plain text; ODD is any other byte.
SPACE, LETTER, DIGIT, SYMBOL, ODD = range(5)
_KIND = np.array([SPACE if c in b" \t\n\v\f\r" else DIGIT if 48 <= c <= 57 else LETTER if chr(c).isascii() and chr(c).isalpha() else SYMBOL if 33 <= c <= 126 else ODD for c in range(256)], np.uint8)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: What can follow an apostrophe in a piece of its own.
_SHORT, _LONG = b"stmd", (b"re", b"ve", b"ll")
_PLAIN = b"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-/:-@\\[-`{-~]+|'(?:[stmd]|re|ve|ll)"


def _byte_letters() -> dict[int, str]:
    """Code points up to U+00FF to the letters that stand for their UTF-8 bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}


_LETTERS = _byte_letters()


def split_pieces(texts: pa.Array, literals: tuple[bytes, ...] = ()) -> tuple[pa.Array, np.ndarray]:
    """(the pieces of all texts, one after another; where the pieces of each text end).

    White space separates chunks.  A chunk of ASCII and of letters up to U+00FF is put in lower case and
    cut into runs of letters, single digits, runs of symbols, and contractions that begin with an
    apostrophe, as the tokenizer cuts it.  A chunk with any other byte, or with the first two bytes of a
    literal, stays whole and as it is.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    starts = (offsets[:-1] - offsets[0])[np.diff(offsets) > 0]
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    kind, low = _KIND[data], _LOWER[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    low[lead + 1] += np.where(data[lead + 1] <= 0x9E, 32, 0).astype(np.uint8)
    before = np.concatenate([[np.uint8(SPACE)], kind[:-1]])
    before[starts] = SPACE
    solid = kind != SPACE
    first = solid & (before == SPACE)
    cut = solid & ((kind != before) | (kind == DIGIT))
    # contractions: the apostrophe begins a piece, and letters of the same chunk follow
    at = np.flatnonzero((data == 39) & cut)
    near = lambda k: np.where((at + k < len(data)) & (before[(at + k).clip(max=len(data) - 1)] != SPACE), low[(at + k).clip(max=len(data) - 1)], 0)
    c1, c2 = near(1), near(2)
    size = np.where(np.isin(c1, list(_SHORT)), 1, 0)
    for a, b in _LONG:
        size = np.where((c1 == a) & (c2 == b), 2, size)
    at, size = at[size > 0], size[size > 0]
    cut[at + 1] = False
    after = at + size + 1
    after = after[after < len(data)]
    cut[after] = solid[after]
    chunk = np.cumsum(first) - 1
    odd = kind == ODD
    for x in literals:
        odd[:-1] |= (data[:-1] == x[0]) & (data[1:] == x[1])
    if odd.any():
        whole = np.zeros(chunk[-1] + 2, bool)
        whole[chunk[odd]] = True
        whole = whole[chunk] & solid
        cut[whole] = first[whole]
        low[whole] = data[whole]
    spans = np.append(np.flatnonzero(cut[solid]), np.count_nonzero(solid)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(spans) - 1, [None, pa.py_buffer(spans), pa.py_buffer(low[solid])])
    return pieces, np.concatenate([[0], np.cumsum(cut)])[ends]


class PieceTokenizer:
    """ids of texts, as the tokenizer's library gives them without special tokens added.

    White space ends a token for this tokenizer, and so do the ends of its pieces, so the ids of a text
    are those of its pieces.  Arrow numbers the distinct pieces of a batch; each is tokenized once while
    it is in use, by the library's model, or where a piece is not plain by the whole library.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.literals = tuple(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model = self.tokenizer.model
        odd = b"|".join(re.escape(x[:2]) for x in self.literals) or b"\\Z."
        self.plain = re.compile(b"(?s)(?!.*?(?:" + odd + b"))(?:" + _PLAIN + b")").fullmatch
        self.known = Generations(CACHE)

    def _learn(self, pieces: list[bytes]) -> None:
        plain, put = [], self.known.put
        for p in pieces:
            if self.plain(p):
                plain.append(p)
            else:
                put(p, np.array(self.tokenizer.encode(p.decode(), add_special_tokens=False).ids, "<u4").tobytes())
        made = list(map(self.model.tokenize, [p.decode() if p.isascii() else p.decode().translate(_LETTERS) for p in plain]))
        ids = np.array([t.id for own in made for t in own], "<u4").tobytes()
        at = 0
        for p, own in zip(plain, made, strict=True):
            put(p, ids[at : at + 4 * len(own)])
            at += 4 * len(own)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; where the ids of each text end)."""
        pieces, text_ends = split_pieces(pc.fill_null(texts, ""), self.literals)
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_pylist()
        self._learn(self.known.absent(set(names)))
        found = [self.known.now[p] for p in names]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = coded.indices.to_numpy()
        first, n = (np.cumsum(size) - size)[at], size[at]
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(found), "<u4")
        ids = ids[np.arange(n.sum()) + np.repeat(first - ends + n, n)]
        return ids, np.concatenate([[0], ends])[text_ends]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every row; a null text is empty and has the end id alone."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = path or tokenizer_path()
        tok = state(("tokenizer", own), lambda: PieceTokenizer(own))
        for batch in byte_slices(batches, 1):
            ids, ends = tok(batch.column(1))
            last = ends + np.arange(len(ends))  # where the end ids go
            every = np.full(len(ids) + len(ends), end_id, "<u4")
            every[np.delete(np.arange(len(every)), last)] = ids
            starts = np.concatenate([[0], last + 1])
            size = np.diff(starts)
            pieces = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            length = np.minimum(size[doc] - piece * capacity, capacity)
            at = starts[doc] + piece * capacity
            view = memoryview(every).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(cut, PIECES)


class Plan:
    """Where pieces go, from the counts of their lengths.  runs: (length, first rank, pieces, first bin, pieces of it in a bin, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        if any(not 0 < s <= capacity for s in counts):
            raise ValueError("lengths must be in 1..capacity")
        self.capacity, self.left = capacity, {s: n for s, n in counts.items() if n}
        self.sizes = sorted(self.left)
        self.used: dict[int, int] = dict.fromkeys(counts, 0)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.bins = self.fixed = 0
        self._reduce()
        self.fixed = self.bins
        self._best_fit()

    def _place(self, s: int, n: int, first: int, per_bin: int, offset: int) -> None:
        self.runs.append((s, self.used[s], n, first, per_bin, offset))
        self.used[s] += n
        self.left[s] -= n
        if not self.left[s]:
            del self.left[s]
            del self.sizes[bisect.bisect_left(self.sizes, s)]

    def _reduce(self) -> None:
        """Go over all lengths, the longest first, as long as a set can be fixed for one of them."""
        done = False
        while not done:
            done = True
            for s in sorted(self.left, reverse=True):
                while s in self.left and self._fix(s):
                    done = False

    def _fix(self, s: int) -> bool:
        """Fix the set that dominates all sets with a piece of length s, if there is one."""
        room, n, own = self.capacity - s, self.left[s], self.sizes
        there = lambda x: self.left[x] - (x == s)
        low = [x for x in own[:4] for _ in range(min(3, there(x)))][:3]  # the smallest others
        if not low or low[0] > room:
            self._place(s, n, self.bins, 1, 0)
            self.bins += n
            return True
        i = bisect.bisect_right(own, room)
        if not there(own[i - 1]):
            i -= 1
        t = own[i - 1]  # the largest that fits beside s
        pairs_fit, triples_fit = len(low) > 1 and low[0] + low[1] <= room, len(low) > 2 and sum(low) <= room
        if t == room or not pairs_fit or not triples_fit and t >= self._best_pair([x for x in own[:i] if there(x)], room, there):
            k = n // 2 if t == s else min(n, self.left[t])
            self._place(s, k, self.bins, 1, 0)
            self._place(t, k, self.bins, 1, s)
            self.bins += k
            return True
        return False

    @staticmethod
    def _best_pair(sizes: list[int], room: int, there: Callable[[int], int]) -> int:
        """The largest sum within room of two pieces that are there."""
        best, i, j = 0, 0, len(sizes) - 1
        while i <= j:
            if i == j and there(sizes[i]) < 2:
                break
            total = sizes[i] + sizes[j]
            if total <= room:
                best, i = max(best, total), i + 1
            else:
                j -= 1
        return best

    def _best_fit(self) -> None:
        free: dict[int, list[tuple[int, int]]] = {}  # free space: groups of (first bin, bins)
        rooms: list[int] = []

        def add(room: int, first: int, n: int) -> None:
            if n and room:
                if room not in free:
                    bisect.insort(rooms, room)
                    free[room] = []
                free[room].append((first, n))

        for s in sorted(self.left, reverse=True):
            todo = self.left[s]
            while todo:
                i = bisect.bisect_left(rooms, s)
                if i < len(rooms):
                    room = rooms[i]
                    first, n = free[room].pop()
                    if not free[room]:
                        del free[room], rooms[i]
                else:
                    room, first, n = self.capacity, self.bins, -(-todo // (self.capacity // s))
                    self.bins += n
                per = room // s
                full = min(n, todo // per)
                rest = min(todo - full * per, per) if full < n else 0
                if full:
                    self._place(s, full * per, first, per, self.capacity - room)
                    add(room - per * s, first, full)
                if rest:
                    self._place(s, rest, first + full, per, self.capacity - room)
                    add(room - rest * s, first + full, 1)
                add(room, first + full + bool(rest), n - full - bool(rest))
                todo -= full * per + rest


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (any columns, and length) with sequence_id and offset; pieces is read several times, so pass a written table.

    Rows are told apart by their place in the table, so repeated rows are packed one by one; columns of
    pieces may have any names, and none is changed.
    """
    spark = pieces.sparkSession
    rows = pieces.select(F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("row"), F.col("length"))
    named = materialize(rows.withColumn("_uid", F.monotonically_increasing_id()), "packing-pieces")
    counts = {r["length"]: r["count"] for r in named.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = Plan(counts, capacity)
    chunks = max(16, -(-sum(counts.values()) // 100_000))
    named = named.withColumn("_chunk", F.pmod(F.xxhash64("_uid"), F.lit(chunks)))
    before = named.groupBy("length", "_chunk").agg(F.count("*").alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_chunk")) - F.col("_n")).drop("_n")
    ranked = named.withColumn("_row", F.row_number().over(Window.partitionBy("length", "_chunk").orderBy("_uid"))).join(before, ["length", "_chunk"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_row") - 1).withColumn("_block", F.floor(F.col("_rank") / RANK_BLOCK))
    names = ["_len", "_from", "_count", "_bin", "_per", "_offset"]
    schema = ", ".join(f"{n} long" for n in names)
    runs = spark.createDataFrame(plan.runs, schema)
    runs = runs.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_from") / RANK_BLOCK), F.floor((F.col("_from") + F.col("_count") - 1) / RANK_BLOCK))))
    inside = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("_count"))
    placed = ranked.join(runs, (F.col("length") == F.col("_len")) & (F.col("_block") == F.col("_b")) & inside)
    at = F.col("_rank") - F.col("_from")
    return placed.select(
        "row.*",
        (F.col("_bin") + F.floor(at / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(at, F.col("_per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(tokenize(docs, capacity=capacity), capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
SQL: dict[str, str] = {}
