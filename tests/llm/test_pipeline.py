from collections import defaultdict

import numpy as np
import pyarrow as pa

import __spark_entry__
import corpus_pipeline
from test_near_dedup import brute as components
from test_secrets import brute as found

from quadrat.llm import packing, quality_classifier


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    cols, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == cols
            after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if k < 2:
            good = [d for d in before if labels.get(d) == 1]
            assert set(after) <= set(before) and sum(d in after for d in good) >= 0.98 * len(good)
            kept.append(sum(labels.get(d) == 0 for d in after))
        if k == 2:
            assert set(after) == {r[0] for r in components(list(before.items()), 5, 80, 100) if r[3]}
        if k == 3:
            assert set(after) == set(before) and all(found(t)[0] == [0, 0, 0] for t in after.values())
            assert all(after[d] == t for d, t in before.items() if found(t)[0] == [0, 0, 0])
        if k == 4:
            rows = docs.collect()
            sums, bins = defaultdict(int), defaultdict(int)
            for r in rows:
                sums[r["doc_id"]] += r["length"]
                bins[r["sequence_id"]] += r["length"]
            _, ends = packing.PieceTokenizer(packing.tokenizer_path())(pa.array(list(before.values()), pa.string()))
            assert dict(sums) == {d: int(n) + 1 for d, n in zip(before, np.diff(ends, prepend=0), strict=True)} and max(bins.values()) <= 4096
    assert kept[0] < 0.4 * sum(q == 0 for q in labels.values()) and kept[1] <= kept[0]


def test_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {n.split("_")[0] for n in names} and set(__spark_entry__.oracle_sql()) <= names


def test_odd_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and columns with the names that stages use go through; so does a table without rows."""
    words = " ".join(f"word{i * 7919 % 613}" for i in range(400))
    rows = [(1, words), (2, words), (2, words), (3, None), (4, ""), (5, " \n"), (None, words + " more"), (None, None), (6, "x" * 300_000), (7, "token = abcdefgh1234 " + words[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'l' lang", "1 _key", "2 _uid", "3 _score", "4 `row`", "5 length", "6 _id", "7 n")
    for k, start in enumerate((docs, docs.limit(0))):
        now = start
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, "/root/testdata/sf0.001")
            now.write.parquet(f"file://{tmp_path}/{k}-{i}")
            now = spark.read.parquet(f"file://{tmp_path}/{k}-{i}")
            if i < 4:
                assert now.columns == docs.columns
                assert all(tuple(r)[2:] == ("l", 1, 2, 3, 4, 5, 6, 7) for r in now.collect())
            if i == 2 and k == 0:  # one of the copies, whatever the stages before have kept
                assert sum(r["text"] == words for r in now.collect()) <= 1
        assert now.count() == 0 if k else now.where("length > 4096").count() == 0
