import random
import re

import numpy as np
import pytest

from quadrat.llm import near_dedup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width, num, den):
    """(id, n, component, kept) by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    inv = {}
    for i, s in enumerate(sets):
        for x in s:
            inv.setdefault(x, []).append(i)
    near = set()
    for members in inv.values():
        near |= {(a, b) for k, a in enumerate(members) for b in members[k + 1 :]}
    for a, b in near:
        both = len(sets[a] & sets[b])
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            comp[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)), d == least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, width=3, num=85, den=100, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 n", "'k' set_key", "2 v")
    return sorted((tuple(r) for r in N.near_duplicates(df, width, num, den, **kw).collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    passage, out = text(60), []
    for n in (5, 40, 200, 400):
        base = text(n)
        for _ in range(8):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, n // 25))):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            out.append(" ".join(t))
    out += [" ".join(text(rnd.randint(10, 300)) + passage) for _ in range(40)]
    near = text(10) + passage  # many short documents that are mostly the passage
    out += [" ".join(near[: 10 - k % 3] + passage + text(k % 4)) for k in range(30)]
    rows = list(enumerate(out))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed) + [(900, None), (901, ""), (902, " \n"), (903, "a"), (904, "A"), (905, "a b"), (906, "b a"), (907, "É x y"), (908, "é x y"), (7, "a b"), (None, "a b"), (None, None), (903, "a")]
    assert run(spark, rows) == brute(rows, 3, 85, 100)
    monkeypatch.setattr(N, "BLOCK", 9)
    monkeypatch.setattr(N, "BLOCK_BYTES", 9 << 10)
    assert run(spark, rows, short_list=3) == brute(rows, 3, 85, 100)  # all but the shortest lists go the exact way


def test_five_words(spark):
    rows = corpus(3)
    assert run(spark, rows, 5, 80, 100, short_list=4) == brute(rows, 5, 80, 100)


@pytest.mark.parametrize("seed", range(20))
def test_joining_edges(seed):
    rnd = np.random.default_rng(seed)
    base = np.arange(60)
    sets = [np.unique(np.concatenate([rnd.choice(base, int(rnd.integers(40, 60)), replace=False), rnd.integers(100, 200, int(rnd.integers(0, 8)))])) for _ in range(25)]
    labels = rnd.integers(0, 12, 25) if seed % 2 else np.arange(25)

    def groups(edges):
        lab = labels.copy()
        for i, j in edges:
            lab[lab == lab[j]] = lab[i]
        return len(set(lab)), [{k for k in range(25) if lab[k] == lab[m]} for m in range(25)]

    near = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    for split in (25, 10):
        every = [(i, j) for i in range(split) for j in range(i + 1 if split == 25 else split, 25) if near(i, j)]
        got = N.joining_edges(np.concatenate(sets), np.array([len(x) for x in sets]), labels, split, 75, 100)
        assert all(near(i, j) for i, j in got) and groups(got) == groups(every) and len(got) == len(set(labels)) - groups(every)[0]


def test_empty_table_and_copies(spark):
    assert run(spark, []) == []
    rows = [(i, "one two three four") for i in range(200)] + [(500, "five")]
    assert run(spark, rows) == sorted([(i, 2, 0, i == 0) for i in range(200)] + [(500, 1, 500, True)], key=str)


def test_keep_one(spark):
    rows = [(2, "a b c d e f", 1), (1, "a b c d e f", 2), (1, "a b c d e f", 2), (3, None, 3), (4, "", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").selectExpr("*", "n AS _key", "n AS _id", "n AS `row`", "n AS id", "n AS key")
    out = N.keep_one(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4]


def test_the_chance_of_a_miss():
    from math import comb

    for t in (0.8, 0.85):
        l = N.most_long(t, 16)  # noqa: E741
        tail = lambda k, t=t: sum(comb(16, i) * t**i * (1 - t) ** (16 - i) for i in range(k + 1))
        assert tail(l) <= 1e-6 < tail(l + 1)


def test_a_pair_of_hot_passages(spark):
    """Documents that are a hot passage and little else, and one that is the passage alone."""
    rnd = random.Random(9)
    passage = [f"p{i}" for i in range(170)]
    rows = [(i, " ".join([f"u{i}-{k}" for k in range(rnd.choice([10, 29, 30, 31, 60, 200]))] + passage)) for i in range(60)] + [(99, " ".join(passage)), (98, " ".join(passage[:60]))]
    for short_list in (16, 4):
        assert run(spark, rows, 3, 85, 100, short_list=short_list) == brute(rows, 3, 85, 100)


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in N.op2_minhash_near_dedup(spark, sf_dir).collect()), key=str) == brute(rows, 3, 85, 100)


def test_sets_move_in_rounds(spark, monkeypatch):
    """What carries full sets moves about as much at a time as all sets have, and the result is the same."""
    rows = [(i, t) for i, t in enumerate(corpus(5))] if not isinstance(corpus(5)[0], tuple) else corpus(5)
    want, moved = brute(rows, 3, 85, 100), {"confirm": 0, "lists": 0}
    confirm, lists = N._confirm, N._search_lists
    monkeypatch.setattr(N, "_confirm", lambda *a: moved.update(confirm=moved["confirm"] + 1) or confirm(*a))
    monkeypatch.setattr(N, "_search_lists", lambda *a: moved.update(lists=moved["lists"] + 1) or lists(*a))
    monkeypatch.setattr(N, "ROUND_BYTES", 1)
    assert run(spark, rows) == want
    assert moved["confirm"] > 1 and moved["lists"] > 1
