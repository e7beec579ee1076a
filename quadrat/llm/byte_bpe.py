"""Byte-level BPE encoding and decoding by DuckDB queries inside Arrow batches.

The merges of a rank file are a table: (left token, right token) to the token that they make, whose id
is its rank.  Each new word (a match of the splitting pattern) enters DuckDB as rows of token and
position; a recursive query joins neighbours with the merge table, contracts the leftmost pair of
minimum rank of every word, and goes on until no word changes.  Decoding joins the ids with the
vocabulary and aggregates the bytes in the order of positions.

What the recursion gathers grows with the steps of a query, so a query takes ``STEPS`` of them at most;
words that have not come to their end go on from there in the next query, and a query takes as many
words as its rows have room for.  A Python worker keeps what its words came to, in two generations of
bounded size, so a word is queried once while it is in use.  Steps times length is still the square of
a word's length, so a word above ``MAX_RECURSIVE`` bytes (the README says how many there are) is
contracted by the same rule with a heap instead.  Rows of the table don't depend on each other: nothing
is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import byte_slices, table
from quadrat.llm.worker import Generations, state

#: Bytes of words and their ids that a worker keeps; steps of a query, and rows that it may gather.
CACHE, STEPS, MAX_QUERY_ROWS = 120 << 20, 48, 3_000_000
MAX_RECURSIVE = 4096

_ENCODE = """
WITH RECURSIVE t(w, pos, tok, npos, nxt, step) AS (
  SELECT w, pos, tok, pos + 1, lead(tok) OVER (PARTITION BY w ORDER BY pos), 0 FROM start
  UNION ALL (
    WITH j AS (
      SELECT t.w, t.pos, t.npos, m.id::BIGINT << 32 | t.pos AS worth
      FROM t JOIN merges m ON m.pair = (t.tok::BIGINT << 32 | t.nxt) WHERE t.step < $1
    ), b AS (
      SELECT w, min(worth) AS best, arg_min(npos, worth) AS gone FROM j GROUP BY w
    ), g AS (
      SELECT b.w, b.best & 4294967295 AS pos, (b.best >> 32)::INT AS tok, b.gone, t.npos, t.nxt
      FROM b JOIN t ON t.w = b.w AND t.pos = b.gone
    )
    SELECT t.w, t.pos,
      CASE WHEN t.pos = g.pos THEN g.tok ELSE t.tok END,
      CASE WHEN t.pos = g.pos THEN g.npos ELSE t.npos END,
      CASE WHEN t.pos = g.pos THEN g.nxt WHEN t.npos = g.pos THEN g.tok ELSE t.nxt END,
      t.step + 1
    FROM t JOIN g ON t.w = g.w WHERE t.pos <> g.gone
  )
), last AS (
  SELECT w, max(step) AS step FROM t GROUP BY w
)
SELECT t.w, any_value(t.step) AS step, count(*) AS n, string_agg(t.tok, ',' ORDER BY t.pos) AS ids, string_agg(v.hex, '' ORDER BY t.pos) AS decoded
FROM t JOIN last USING (w, step) JOIN vocabulary v ON v.id = t.tok
GROUP BY t.w ORDER BY t.w
"""


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Codec:
    """Encoder and decoder of a rank file."""

    def __init__(self, path: str, pattern: str | None = None) -> None:
        import duckdb
        import public_tokenizers
        import regex

        self.split = regex.compile(pattern or public_tokenizers.PATTERN).findall
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]] << 32 | ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.made, self.spelled = dict(pairs), {i: t for t, i in ranks.items()}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})  # it works in memory only
        made = pa.table({"pair": [p for p, _ in pairs], "id": pa.array([i for _, i in pairs], pa.int32())})
        known = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
        for name, rows in (("merges", made), ("vocabulary", known)):
            self.db.register("_rows", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM _rows")
            self.db.unregister("_rows")
        #: word to (ids with commas, number of ids, decoded bytes)
        self.known = Generations(CACHE, lambda v: len(v[0]) + len(v[2]) + 150)

    def _put(self, word: str, n: int, ids: str, decoded: bytes) -> None:
        self.known.put(word, (ids.encode(), n, decoded))

    def _query(self, words: list[str]) -> None:
        left = {i: self.bytes[np.frombuffer(w.encode(), np.uint8)] for i, w in enumerate(words)}
        while left:
            sizes = np.array([len(t) for t in left.values()])
            ends = np.cumsum(sizes)
            start = {"w": np.repeat(np.fromiter(left, np.int32, len(left)), sizes), "pos": (np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int32), "tok": np.concatenate(list(left.values()))}
            self.db.register("start", pa.table(start))
            got = self.db.execute(_ENCODE, [STEPS]).fetchall()
            self.db.unregister("start")
            left = {}
            for w, step, n, ids, decoded in got:
                if step < STEPS:
                    self._put(words[w], n, ids, bytes.fromhex(decoded))
                else:
                    left[w] = np.array(ids.split(","), np.int32)

    def _contract(self, word: str) -> None:
        """The same by a heap of (rank, position) over linked tokens."""
        tok = self.bytes[np.frombuffer(word.encode(), np.uint8)].tolist()
        after, before = [*range(1, len(tok)), -1], list(range(-1, len(tok) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (made := self.made.get(tok[i] << 32 | tok[j])) is not None:
                heapq.heappush(heap, (made, i, tok[i], tok[j]))

        for i in range(len(tok)):
            offer(i)
        while heap:
            made, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tok[i] != a or j < 0 or tok[j] != b:
                continue
            tok[i], tok[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        ids = [t for t in tok if t >= 0]
        self._put(word, len(ids), ",".join(map(str, ids)), b"".join([self.spelled[t] for t in ids]))

    def learn(self, words: set[str]) -> None:
        """Have all words in self.known.now."""
        fresh, rows = [], 0
        for w in self.known.absent(words):
            size = len(w.encode())
            if size > MAX_RECURSIVE:
                self._contract(w)
                continue
            fresh.append(w)
            rows += size * min(size, STEPS)
            if rows > MAX_QUERY_ROWS:
                self._query(fresh)
                fresh, rows = [], 0
        if fresh:
            self._query(fresh)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, bytes, bytes]]:
        """(number of ids, ids with commas, bytes decoded from the ids) of each text; a null text is empty."""
        split = [self.split(t or "") for t in texts]
        self.learn(set().union(*split))
        now = self.known.now
        for words in split:
            got = [now[w] for w in words]
            yield sum([g[1] for g in got]), b",".join([g[0] for g in got]), b"".join([g[2] for g in got])


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and with keep_ids also ids and decoded) of every row.

    A null text is an empty one: no ids, and the digests of nothing.  Repeated rows are encoded one by
    one; a null id stays null.  decoded comes from the ids, not from the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = path or vocabulary_path()
        codec = state(("codec", own), lambda: Codec(own))
        for b in byte_slices(batches, 1, 1000):
            n, ids_hex, decoded_hex, ids, decoded = [], [], [], [], []
            for count, joined, back in codec.encode(b.column(1).to_pylist()):
                n.append(count)
                ids_hex.append(hashlib.sha256(joined).hexdigest())
                decoded_hex.append(hashlib.sha256(back).hexdigest())
                if keep_ids:
                    ids.append([int(x) for x in joined.split(b",")] if joined else [])
                    decoded.append(back.decode())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, kind).withColumnRenamed("doc_id", id_col)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
SQL: dict[str, str] = {}
