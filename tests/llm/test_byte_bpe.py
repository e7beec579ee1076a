import base64
import hashlib

import public_tokenizers
import tiktoken

from quadrat.llm import byte_bpe as B


def reference():
    with open(B.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", " ", "a", "aaaaaaaaaa", "ababababab" * 50, "It's  é🙂 日本語 <|endoftext|>\n\n\tx 12345", "\x00\x85", "erthingtionnd " * 5000, "z" * 200000, "thererand" * 20, "ertionthé" * 9000, "hello hello"]


def test_equals_the_library(spark, sf_dir):
    enc = reference()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (-1, None)], "doc_id long, text string"))
    want = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r["text"] or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    got = [tuple(r) for r in B.encode_texts(docs.selectExpr("*", "1 n_tokens", "2 ids")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ids_and_small_caches(spark, monkeypatch):
    enc = reference()
    for cache, rows, steps, recursive in ((1, 5, 48, 4096), (1 << 20, 3_000_000, 3, 4096), (1000, 100, 1, 300), (1, 5, 48, 4)):
        for k, v in (("CACHE", cache), ("MAX_QUERY_ROWS", rows), ("STEPS", steps), ("MAX_RECURSIVE", recursive)):
            monkeypatch.setattr(B, k, v)
        codec = B.Codec(B.vocabulary_path())
        for some in (TEXTS[:8], TEXTS[10:11], TEXTS[:8]):
            for t, (n, ids, back) in zip(some, codec.encode(some), strict=True):
                assert ids.decode() == ",".join(map(str, enc.encode_ordinary(t or ""))) and back == (t or "").encode() and n == len(enc.encode_ordinary(t or ""))
    got = B.encode_texts(spark.createDataFrame([(1, "two words")], "doc_id long, text string"), keep_ids=True).first()
    assert got["ids"] == enc.encode_ordinary("two words") and got["decoded"] == "two words"


def test_long_words_go_through_the_query(monkeypatch):
    """No result changes at the old limit of 256 bytes, nor up to MAX_RECURSIVE."""
    enc, codec = reference(), B.Codec(B.vocabulary_path())
    monkeypatch.setattr(codec, "_contract", None)
    words = ["therand" * 40, "z" * 255, "z" * 256, "z" * 257, "ertionthé" * 100, "qx7" * 400]
    for t, (_, ids, _) in zip(words, codec.encode(words), strict=True):
        assert ids.decode() == ",".join(map(str, enc.encode_ordinary(t)))


def test_empty(spark):
    assert B.encode_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
