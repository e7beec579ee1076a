import numpy as np

from quadrat.llm import quality_classifier as C


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in C.op4_quality_classifier(spark, sf).collect()}
    labels = [(r["quality"], got[r["doc_id"]]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(q, r) for q, r in labels if r["held_out"]]
    good, low = [r for q, r in held if q == 1], [r for q, r in held if q == 0]
    print("held out: kept of good", np.mean([r["predicted"] for r in good]), "of low", np.mean([r["predicted"] for r in low]), "share above", np.mean([a["score"] > b["score"] for a in good for b in low]))
    assert np.mean([r["predicted"] for r in good]) > 0.98 and np.mean([r["predicted"] for r in low]) < 0.2
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values()) and len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, None), (None, ""), (3, "x " * 200000)], "doc_id long, text string").selectExpr("*", "1 _label", "2 quality")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    model = C.fit(docs, labels)
    rows = C.score(docs, model).collect()
    assert len(rows) == 5 and rows[2]["_score"] == rows[3]["_score"] and all(0 <= r["_score"] <= 1 for r in rows)
    none = C.fit(docs.limit(0), labels.limit(0))
    assert C.score(docs.limit(0), none).count() == 0 and len({r["_score"] for r in C.score(docs, none).collect()}) == 1
    assert C.keep_above(docs, model, 0.0).columns == docs.columns and C.keep_above(docs, model, 0.0).count() == 5


def test_vectors_follow_neighbours(spark):
    texts = ["red fox runs fast", "red dog runs fast", "blue sky sits still", "blue sea sits still"] * 20
    v = C.Vectors(C.learn_vectors(spark.createDataFrame([(t,) for t in texts], "text string")))
    near = lambda a, b: float(v.context[a] @ v.context[b])
    assert near(b"fox", b"dog") > near(b"fox", b"sky") and C.shape(b"THE!!") == b"A!"


def test_context_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 3)
    monkeypatch.setattr(C, "FAN_IN", 2)
    monkeypatch.setattr(C, "HELD_WORDS", 4)
    texts = ["a b c a", "A\t b \n", None, "", "d e f g h i", "c c c", "x " * 3000, "b é É"] * 3
    got = C.learn_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(7))
    sums = {}
    for t in texts:
        ws = (t or "").encode().lower().split()
        for i, w in enumerate(ws):
            for j in range(max(0, i - 2), min(len(ws), i + 3)):
                if j != i:
                    sums[w] = sums.get(w, 0) + C.index_matrix([ws[j]])[0] * np.sqrt(C.NONZERO)
    assert set(got) == {w for t in texts for w in (t or "").encode().lower().split()}
    for w, x in got.items():
        want = sums.get(w, np.zeros(C.DIM))
        assert np.allclose(x, want / (np.linalg.norm(want) or 1), atol=1e-6)
    assert len(C.learn_vectors(spark.createDataFrame([(t,) for t in texts], "text string"), 4)) <= 4


def test_long_labelled_texts_and_repeated_rows(spark):
    rows = [(i, ("good words here " if i % 2 else "BAD!! $$ ") * (4000 if i < 6 else 5)) for i in range(60)]
    docs = spark.createDataFrame(rows + [(1, rows[1][1])] * 500 + [(2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    own = C.Network.__init__
    try:
        C.Network.__init__ = lambda self, x, y, **kw: (seen.append((len(x), float(x[:, 2 * C.DIM].max()))), own(self, x, y, **kw))[1]
        model = C.fit(docs, labels)
    finally:
        C.Network.__init__ = own
    assert seen[0][0] == 60 and seen[0][1] > np.log1p(11000) / 10  # one row an id, the long texts among them
    assert all((r["_score"] > 0.5) == bool(r["doc_id"] % 2) for r in C.score(docs.where("text IS NOT NULL"), model).collect())


def test_scores_equal_brute_force(spark):
    rows = [(i, ("good words here " if i % 2 else "BAD!! $$ ") + f"w{i} " * (i % 4)) for i in range(40)] + [(90, ""), (91, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    context, net = C.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"))
    index = lambda f: C.index_matrix([f])[0]
    for r in C.score(docs, (context, net)).collect():
        ws, raw = (r["text"] or "").encode().lower().split(), (r["text"] or "").encode().split()
        x = np.zeros(2 * C.DIM + 4)
        if ws:
            x[: C.DIM] = np.mean([index(w) + context.get(w, 0) for w in ws], axis=0)
            x[C.DIM : 2 * C.DIM] = np.mean([index(b"\0" + C.shape(w)) for w in raw], axis=0)
            share = np.array([ws.count(w) / len(ws) for w in set(ws)])
            x[2 * C.DIM :] = np.log1p(len(ws)) / 10, len(set(ws)) / len(ws), np.sqrt((share**2).sum()), np.linalg.norm(x[: C.DIM])
        z = np.tanh(((x - net.mean) / net.sd).clip(-6, 6) @ net.p[0] + net.p[1]) @ net.p[2] + net.p[3][0]
        assert abs(r["_score"] - 1 / (1 + np.exp(-z / net.temperature))) < 1e-5
