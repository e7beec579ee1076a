import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quadrat.llm import lm_score as L


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(rows):
    train = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 10 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    out = {}
    for d, t in rows:
        ws = tokens(t)
        out[d] = (zlib.crc32(str(d).encode()) % 10 == 0, len(ws), sum(train[w] > 0 for w in ws), n, sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
    return out


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want, got = brute(rows), L.op6_lm_score(spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:5] == want[r["doc_id"]][:4] and r["base_score"] == pytest.approx(want[r["doc_id"]][4], rel=1e-9)
    held = [r for r in got if r["held_out"]]
    size = {d: len((t or "").encode()) for d, t in rows}
    bits = -sum(r["score"] for r in held) / math.log10(2) / sum(size[r["doc_id"]] for r in held)
    print("bits per byte", bits)
    assert bits < 3.2


def test_rare_words_and_odd_rows(spark):
    rows = [(i, f"the Word{i % 7} x{i}") for i in range(40)] + [(100, None), (101, ""), (102, "é " + "y" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 n_tokens", "2 score", "3 word")
    for head in (0, 3, 1000):
        held = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 10 == 0]
        model = L.Model(df.where(~df.doc_id.isin(held)), head)
        want = brute(rows)
        got = L.score(df.union(df.where("doc_id < 3")), model).collect()
        assert len(got) == len(rows) + 3
        for r in got:
            assert (r["n_tokens"], r["n_known"]) == want[r["doc_id"]][1:3] and r["base_score"] == pytest.approx(want[r["doc_id"]][4])


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.score(df, L.Model(df)).count() == 0
    r = L.score(spark.createDataFrame([(1, "ab")], df.schema), L.Model(df)).first()
    assert r["n_known"] == 0 and r["base_score"] == 0 and r["score"] == pytest.approx(24 * math.log10(0.5), rel=0.2)


def contexts_of(texts):
    w, n = L.counted_windows(texts)
    first = np.zeros(L.FIRST, np.int64), np.zeros(L.FIRST, np.int64)
    for bit in range(8):
        one = (w >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        np.add.at(first[1], L.first_slot(w, bit)[one], n[one])
        np.add.at(first[0], L.first_slot(w, bit)[~one], n[~one])
    return L.Contexts(first, w, n)


def test_probabilities_add_up():
    costs = L.Costs(contexts_of([b"the cat and the dog and the hen " * 9]), L.Mixer())
    context = np.uint64(int.from_bytes(b"d the", "big")) << np.uint64(8)
    assert (10 ** costs.compute(context | np.arange(256, dtype=np.uint64))).sum() == pytest.approx(1)
    w = L.counted_windows([b"the cat", b"zzz", b""])[0]
    known = L.Known(w, costs.compute(w).astype(np.float32))
    assert known.texts([b"the cat", b"", b"the cat"])[0] == known.texts([b"zzz", b"the cat"])[1]


def test_scores_equal_brute_force(spark):
    """The score of each text from naive counts of contexts and the learned weights, bit by bit."""
    rows = [(i, f"plot {i % 5} of the forest, number {i * 37 % 11}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = L.Model(df)
    seen = Counter()
    for _, t in rows:
        b = b"\0" * 5 + t.encode() + b"\0"
        for i in range(5, len(b)):
            for k in range(1, 6):
                for bit in range(8):
                    seen[k, b[i - k : i], bit, b[i] >> 8 - bit, b[i] >> 7 - bit & 1] += 1
    mixer = model.mixer.value
    level = lambda n: sum(n >= x for x in (1, 8, 128))

    def score(text):
        b, total = b"\0" * 5 + text.encode() + b"\0", 0.0
        for i in range(5, len(b)):
            for bit in range(8):
                n = {k: [seen[k, b[i - k : i], bit, b[i] >> 8 - bit, one] for one in (0, 1)] for k in range(1, 6)}
                x = [max(-12, min(12, math.log((n[k][1] + 0.05) / (n[k][0] + 0.05)))) for k in range(1, 6)] + [0.3]
                gate = (bit * 4 + level(sum(n[5]))) * 4 + level(sum(n[3]))
                dot = max(-12, min(12, sum(a * c for a, c in zip(x, mixer.weights[gate].tolist()))))
                p = 1 / (1 + math.exp(-dot))
                cell = bit * L.CELLS + round((max(-8, min(8, dot)) + 8) * (L.CELLS - 1) / 16)
                p = (p + (mixer.ones[cell] + 32 * p) / (mixer.seen[cell] + 32)) / 2
                p = min(max(p, 1e-6), 1 - 1e-6)
                total += math.log10(p if b[i] >> 7 - bit & 1 else 1 - p)
        return total

    some = [(1, "plot 3 of the forest"), (2, "unseen \u00e9 words"), (3, None), (4, "the the the")]
    for r in L.score(spark.createDataFrame(some, df.schema), model).collect():
        text = dict(some)[r["doc_id"]] or ""
        assert r["score"] == pytest.approx(score(text), rel=1e-3)
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / (len(text.encode()) + 1))


def test_what_a_task_holds_changes_nothing(spark, monkeypatch):
    rows = [(i, f"plot {i % 9} of the forest number {i * 37 % 101}") for i in range(2000)]
    want = L.Model(spark.createDataFrame(rows, "doc_id long, text string").repartition(1))
    monkeypatch.setattr(L, "HELD_WINDOWS", 50)
    monkeypatch.setattr(L, "HELD_WORDS", 20)
    got = L.Model(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert np.allclose(got.mixer.value.weights, want.mixer.value.weights) and got.head.value == want.head.value and (got.tokens, got.distinct) == (want.tokens, want.distinct)


def test_windows():
    w, starts, ends = L.windows([b"ab", b""])
    assert [int(x) for x in w[starts[0] : ends[0]]] == [0x61, 0x6162, 0x616200] and (starts[1], ends[1]) == (ends[0] + 5, ends[0] + 6) and w[starts[1]] == 0


def test_contexts_are_counted_apart():
    """As many contexts as there are, none of them with the counts of another: more than any number of slots fixed beforehand."""
    rng = np.random.default_rng(0)
    w = np.unique(rng.integers(0, 1 << 48, 400_000).astype(np.uint64))
    n = rng.integers(1, 200, len(w))
    first = np.zeros(65536, np.int64), np.zeros(65536, np.int64)
    some = rng.choice(len(w), 5000, replace=False)
    for bit, (x, _) in enumerate(L.Contexts(first, w, n).each(w[some])):
        one = w[some] >> np.uint64(7 - bit) & np.uint64(1)
        zeros, ones = np.where(one, 0, n[some]), np.where(one, n[some], 0)
        assert np.abs(x[:, 4] - np.log((ones + 0.05) / (zeros + 0.05)).clip(-12, 12)).max() < 1e-4


def test_contexts_equal_brute_force():
    text = b"the cat and the dog and the hen; that hat " * 3
    w, n = L.counted_windows([text, b"other words"])
    first = np.full(65536, 1000), np.full(65536, 1000)
    for own in (0, 1):
        for bit, (x, gate) in enumerate(L.Contexts(first, w, n).each(w, own)):
            for i, v in enumerate(int(v) for v in w):
                for k in range(2, 6):
                    same = [(int(u), m) for u, m in zip(w, n) if int(u) >> 8 & (1 << 8 * k) - 1 == v >> 8 & (1 << 8 * k) - 1 and (int(u) & 255) >> 8 - bit == (v & 255) >> 8 - bit]
                    c = [sum(m for u, m in same if u >> 7 - bit & 1 == one) - own * (v >> 7 - bit & 1 == one) for one in (0, 1)]
                    assert x[i, k - 1] == pytest.approx(math.log((c[1] + 0.05) / (c[0] + 0.05)), rel=1e-4, abs=1e-6)


def test_shards_and_chunks_do_not_change_scores(spark, monkeypatch):
    rows = [(i, f"plot {i % 9} of the forest number {i * 37 % 101}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    one = L.Model(df)
    monkeypatch.setattr(L, "SHARD_BYTES", 10_000)
    many = L.Model(df)
    assert one.shards == 1 and many.shards > 5
    many.mixer = one.mixer
    want = {r["doc_id"]: r["score"] for r in L.score(df, one).collect()}
    monkeypatch.setattr(L, "CHUNK_BYTES", 20_000)
    got = {r["doc_id"]: r["score"] for r in L.score(df, many).collect()}
    assert len(got) == 3000 and all(got[d] == pytest.approx(want[d], rel=1e-6) for d in want)
