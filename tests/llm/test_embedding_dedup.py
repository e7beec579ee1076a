import numpy as np
import pytest

from quadrat.llm import embedding_dedup as E


def brute(rows, least=0.93):
    """(id, links, component, kept) and the linked pairs."""
    ok = [e is not None and l is not None and all(c is not None and np.isfinite(c) for c in e) and any(c != 0 for c in e) for _, e, l in rows]
    unit = [np.asarray(e, float) / np.linalg.norm(np.asarray(e, float)) if k else None for (_, e, _), k in zip(rows, ok)]
    comp, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                comp[root(i)] = root(j)
    first = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            first[root(i)] = min(d, first.get(root(i), d))
    return sorted(((d, links[i], first.get(root(i)), d == first.get(root(i))) for i, (d, _, _) in enumerate(rows)), key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 v", "2 key", "3 times")
    return sorted((tuple(r) for r in E.near_vectors(df).collect()), key=str)


def cluster(rng, n, near, dim=16):
    base = rng.standard_normal((n, dim))
    out = [b for b in base]
    out += [base[0] + 0.03 * rng.standard_normal(dim) for _ in range(near)]
    return [x.astype(np.float32).tolist() for x in out]


@pytest.mark.parametrize("block", [1024, 7])
def test_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", block)
    rng = np.random.default_rng(3)
    vecs = cluster(rng, 60, 40)
    rows = [(i, v, i % 2) for i, v in enumerate(vecs)] + [(200 + i, vecs[0], 0) for i in range(25)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [1.0, 2.0], vecs[0]]
    rows += [(300 + i, v, 0) for i, v in enumerate(odd)] + [(400, vecs[0], None), (401, vecs[0], None), (None, vecs[0], 0), (None, None, 0), (0, vecs[0], 0)]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 0)]) == [(1, 0, 1, True)]


def test_query_recall(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = sorted(tuple(r) for r in E.op7_embedding_near_dedup(spark, sf_dir).collect()), brute(rows)
    links = {r[0]: r[1] for r in want}
    assert all(r[1] <= links[r[0]] for r in got) and sum(r[1] for r in got) >= 0.95 * sum(links.values())


def test_tables():
    for width in (6, 16, 17, 25, 40):
        tables = E.tables_for(width, 64)
        hit = (1 - np.arccos(0.95) / np.pi) ** len(tables[0])
        assert all(len(set(t)) == len(t) == width and max(t) < 64 for t in tables) and (1 - hit) ** len(tables) <= 0.01


def test_widths_follow_the_label(spark):
    n = {k: spark.range(1).select(E.width_for(E.F.lit(k)).alias("w")).first()["w"] for k in (1, 100, 10**5, 2 * 10**6, 10**9)}
    assert n[1] == n[100] == 6 and n[10**5] == 12 and n[2 * 10**6] == 16 and n[10**9] == 25


@pytest.mark.parametrize("width", [16, 17, 24])
def test_recall_of_wide_tables_and_of_labels_of_all_sizes(spark, width, monkeypatch):
    """Beyond the 16 bits that once were the most, and with one label that has most of the vectors."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((80, 32))
    vecs = [(b + 0.12 * rng.standard_normal(32)).astype(np.float32).tolist() for b in base for _ in range(6)]
    rows = [(i, v, 0 if i % 10 else 1 + i % 7) for i, v in enumerate(vecs)]
    monkeypatch.setattr(E, "width_for", lambda n: E.F.when(n > 100, width).otherwise(6))
    got, want = run(spark, rows), brute(rows)
    links = {r[0]: r[1] for r in want}
    assert all(r[1] <= links[r[0]] for r in got) and sum(r[1] for r in got) >= 0.95 * sum(links.values()) > 500
