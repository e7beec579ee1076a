import re
from collections import Counter

from quadrat.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "x y\nx y\n\nx y\n", "é#*🙂 $ %|<>", "a b c d a b c e a b", "w " * 30000, "l1\r\nl1\r\nl1", " a b c\n".join("xyz")]


def test_statistics_equal_brute_force(spark, sf_dir):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "1 n_words", "2 _w")
    got = {r["doc_id"]: tuple(r)[1:6] for r in Q.text_statistics(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r["doc_id"]: brute(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: tuple(r)[1:6] for r in Q.text_statistics(docs).collect()} == want


def test_learner_finds_a_conjunction():
    rows = [({"a": i % 10, "b": i // 10, "c": i % 3}, i % 10 > 6 and i // 10 <= 4) for i in range(100)]
    rules = Q.learn_rules(rows, ("a", "b", "c"))
    assert rules and all({c.feature for c in r} <= {"a", "b"} for r in rules)
    assert all(any(Q._covers(r, x) for r in rules) == bad for x, bad in rows)
    assert Q.learn_rules([(x, False) for x, _ in rows], ("a",)) == [] and Q.learn_rules([], ("a",)) == []


def test_query(spark, sf_dir):
    got = {r["doc_id"]: r for r in Q.op5_quality_rules(spark, sf_dir).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    low, good = [got[i]["rule"] is not None for i, q in labels.items() if q == 0], [got[i]["rule"] is not None for i, q in labels.items() if q == 1]
    assert sum(low) > 0.6 * len(low) and sum(good) <= 0.01 * len(good)
    for r in got.values():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def features(text):
    """The learned conditions' numbers of a text, by their definitions."""
    text = text or ""
    w, n = WORD.findall(text), brute(text)
    lines = sum(bool(WORD.search(x)) for x in text.split("\n"))
    share = lambda a, b: a / b if b else 0.0
    return {
        "symbol_share": share(n[2], n[1]), "upper_share": share(sum("A" <= c <= "Z" for c in text), n[1]), "exclaim_share": share(text.count("!"), n[0]), "dup_line_share": share(n[3], lines),
        "repeat_word_share": share(n[4], n[0]), "distinct_share": share(len(set(w)), n[0]), "mean_word": share(n[1], n[0]), "pipe_share": share(text.count("|"), n[0]),
    }


def test_rules_equal_brute_force(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = Q.fit(docs.select("doc_id", "text"), labels)
    assert rules
    got = {r["doc_id"]: r for r in Q.op5_quality_rules(spark, sf_dir).collect()}
    for r in docs.collect():
        f, n = features(r["text"]), brute(r["text"])
        rule = next((k for k, x in enumerate(rules, 1) if Q._covers(x, f)), None)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        assert (got[r["doc_id"]]["rule"], got[r["doc_id"]]["kept"]) == (rule, rule is None and not failed)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string").selectExpr("*", "7 quality", "8 _lid")
    labels = spark.createDataFrame([(1, None, 3), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert [r["kept"] for r in Q.judge(docs, labels).collect()] == [False] * 3
    assert Q.keep_good(docs, labels).count() == 3 and Q.keep_good(docs, labels).columns == docs.columns
    assert Q.judge(docs.limit(0), labels.limit(0)).count() == 0
