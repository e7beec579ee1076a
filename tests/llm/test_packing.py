import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quadrat.llm import packing as P


def lay_out(plan):
    bins = defaultdict(list)
    for s, _, n, first, per, offset in plan.runs:
        for k in range(n):
            bins[first + k // per].append((offset + k % per * s, s))
    return bins


def best_fit_decreasing(counts, c):
    free = []
    for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        fit = [r for r in free if r >= s]
        if fit:
            free.remove(min(fit))
            free.append(min(fit) - s)
        else:
            free.append(c - s)
    return len(free)


@pytest.mark.parametrize("seed", range(30))
def test_plans(seed):
    rnd = random.Random(seed)
    c = rnd.choice([10, 37, 100])
    counts = {s: rnd.randint(0, 12) for s in rnd.sample(range(1, c + 1), rnd.randint(1, min(c, 25)))}
    plan = P.Plan(counts, c)
    bins = lay_out(plan)
    for items in bins.values():
        at = 0
        for offset, s in sorted(items):
            assert offset == at
            at += s
        assert at <= c
    got = defaultdict(int)
    for items in bins.values():
        for _, s in items:
            got[s] += 1
    assert got == {s: n for s, n in counts.items() if n} and len(bins) == plan.bins
    assert plan.bins <= best_fit_decreasing(counts, c) and plan.bins >= -(-sum(s * n for s, n in counts.items()) // c)


def test_the_reduction_keeps_an_optimum():
    def optimum(items, c):
        best = [len(items)]

        def go(k, free):
            if len(free) >= best[0]:
                return
            if k == len(items):
                best[0] = len(free)
                return
            for i in {f: i for i, f in enumerate(free)}.values():
                if free[i] >= items[k]:
                    go(k + 1, free[:i] + [free[i] - items[k]] + free[i + 1 :])
            go(k + 1, [*free, c - items[k]])

        go(0, [])
        return best[0]

    for seed in range(60):
        rnd = random.Random(seed)
        items = sorted((rnd.randint(3, 20) for _ in range(9)), reverse=True)
        plan = P.Plan({s: items.count(s) for s in items}, 20)
        rest = []
        for b, inside in lay_out(plan).items():
            if b >= plan.fixed:
                rest += [s for _, s in inside]
        assert plan.fixed + optimum(sorted(rest, reverse=True), 20) == optimum(items, 20)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, "'s It's <|endoftext|> É1²x\xa0y ﬁ ς Σ é İ z\x1cq"), (-4, "ab " * 9000), (-4, "ab " * 9000), (None, "x")]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).selectExpr("*", "1 length", "2 _uid")
    assert P.pack(P.tokenize(docs).selectExpr("*", "7 _uid", "8 `row`")).where("_uid = 7 AND `row` = 8").count() > 1000
    got = P.pack_documents(docs).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.tokenizer_path())
    want = defaultdict(int)
    for r in docs.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[r["doc_id"], k // 4096, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    have, bins = defaultdict(int), defaultdict(list)
    for r in got:
        have[tuple(r)[:5]] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 4096


def test_pieces_are_those_of_the_library():
    import pyarrow as pa
    from tokenizers import Tokenizer

    t, tok = Tokenizer.from_file(P.tokenizer_path()), P.PieceTokenizer(P.tokenizer_path())
    rnd = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "'s", "'RE", "''ll", "'d'm", "don't", "É", "\xd7", "\xf7", "ß", "µ", "²", "\xa0", "\u0301", "ﬁ", "İ", "中文", "🙂", "\x1c", "\x7f", " ", "\n", "\t ", "a", "Zz", "12", ",", "'", "`[", "\\", "x" * 50, "«¿Qué?»"]
    texts = [None, "", " ", "\n\n", "'", "s", "'s"] + ["".join(rnd.choices(parts, k=rnd.randint(1, 12))) for _ in range(3000)]
    for at in (0, 5):  # a slice too
        ids, ends = tok(pa.array(["zz"] * at + texts).slice(at))
        got = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert tok(pa.array([], pa.string()))[1].tolist() == []


def test_a_small_cache_changes_nothing(monkeypatch):
    import pyarrow as pa

    texts = pa.array([f"word{i % 97} " * 20 + "y" * 6000 for i in range(300)])
    want = P.PieceTokenizer(P.tokenizer_path())(texts)[0].tolist()
    monkeypatch.setattr(P, "CACHE", 2000)
    tok = P.PieceTokenizer(P.tokenizer_path())
    assert sum([tok(texts.slice(i, 10))[0].tolist() for i in range(0, 300, 10)], []) == want and len(tok.known.now) < 50


def test_empty(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
