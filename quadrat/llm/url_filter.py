"""URL filters by a weighted vocabulary, with host and path rules before it.

An Aho-Corasick automaton counts vocabulary terms in the lower-cased URL.  A hit counts only between
boundaries: the characters beside it must not be letters or digits.  A term has a weight; the weights of
the distinct terms of a URL add up, and ``LIMIT`` rejects it.  A strict term has the limit as its weight,
so one is enough; of soft terms it takes several.  The vocabulary is a table (term, weight): that of
``url_terms.csv``, or any that ``load_vocabulary`` reads.  A list of rules (a host with its subdomains,
and a path prefix) decides before the vocabulary; of the rules that fit, the longest wins.

Rows are independent of each other: there is no shuffle, and no group of rows meets in a task.  The
vocabulary is broadcast; one of more than ``MAX_TERMS`` terms is refused.
"""

from __future__ import annotations

import csv
import io
import pkgutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import table
from quadrat.llm.worker import state

LIMIT = 6
MAX_TERMS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


def own_vocabulary() -> dict[str, int]:
    """Terms and weights of the table beside this module, which may lie in a zip file."""
    text = pkgutil.get_data("quadrat.llm", "url_terms.csv").decode()
    return {r["term"]: int(r["weight"]) for r in csv.DictReader(io.StringIO(text, newline=""))}


def load_vocabulary(terms: DataFrame, most: int = MAX_TERMS) -> dict[str, int]:
    """Terms and weights of a table (term, weight): A-Z in lower case, empty and null terms left out, of equal terms the largest weight.

    The rows are counted before they are fetched; more than `most` are an error.
    """
    own = terms.select(F.translate("term", _UPPER, _LOWER).alias("term"), F.col("weight").cast("int").alias("weight")).where("term != '' AND weight > 0").groupBy("term").agg(F.max("weight").alias("weight"))
    if (n := own.count()) > most:
        raise ValueError(f"{n} terms are more than {most}")
    return {r["term"]: r["weight"] for r in own.collect()}


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values of the query's contract.
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)

def automaton(vocabulary: dict[str, int]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        a.add_word(term, (term, weight))
    a.make_automaton()
    return a


def count_terms(url: str | None, terms, limit: int = LIMIT) -> tuple[int, int, int]:
    """Distinct strict and distinct soft terms of a URL that stand between boundaries, and the sum of their weights."""
    if not url or not len(terms):
        return 0, 0, 0
    low = url.translate(_FOLD)
    word = lambda i: 0 <= i < len(low) and low[i].isascii() and low[i].isalnum()
    hits = dict(hit for end, hit in terms.iter(low) if not word(end + 1) and not word(end - len(hit[0])))
    strict = sum(w >= limit for w in hits.values())
    return strict, len(hits) - strict, sum(hits.values())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for a null URL and for one without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES, vocabulary: dict[str, int] | None = None, limit: int = LIMIT) -> DataFrame:
    """(page id, host, path, rule, n_strict, n_soft, weight, verdict) of every row, repeated rows included.

    A null URL, an empty one and one without ``://`` have an empty host and path, so no rule fits
    them; the vocabulary still judges what text there is, and a null URL is allowed.  A null id stays
    null.  Other columns are not looked at, whatever their names.
    """
    own = own_vocabulary() if vocabulary is None else vocabulary
    sc = pages.sparkSession.sparkContext
    shared, key = sc.broadcast(own), f"{sc.applicationId}-{uuid.uuid4().hex}"

    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms = state(key, lambda: automaton(shared.value))
        for urls in batches:
            yield pd.DataFrame([count_terms(u, terms, limit) for u in urls], columns=["n_strict", "n_soft", "weight"])

    counts = F.pandas_udf(counted, "n_strict long, n_soft long, weight long")
    host, path = host_and_path(F.col("_url"))
    own = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url"))
    own = own.withColumns({"host": host, "path": path, "_hits": counts(F.col("_url"))})
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, said = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(said)
    rejected = F.col("_hits.weight") >= limit
    return own.select(
        F.col("_id").alias(id_col), "host", "path", rule.alias("rule"),
        F.col("_hits.n_strict").alias("n_strict"), F.col("_hits.n_soft").alias("n_soft"), F.col("_hits.weight").alias("weight"),
        F.coalesce(said, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def _sql() -> str:
    terms = own_vocabulary()
    hit = lambda t: f"regexp_matches(translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}'), '(^|[^a-z0-9]){t}($|[^a-z0-9])')::BIGINT"
    count = lambda keep: " + ".join(hit(t) for t, w in terms.items() if keep(w))
    cases = lambda what: " ".join(f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{r.text if what == 'rule' else r.verdict}'" for r in sorted(RULES, key=lambda r: -len(r.text)))
    return f"""
WITH a AS (
  SELECT page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), b AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path,
    {count(lambda w: w >= LIMIT)} AS n_strict,
    {count(lambda w: w < LIMIT)} AS n_soft,
    {' + '.join(f'{w} * {hit(t)}' for t, w in terms.items())} AS weight
  FROM a
)
SELECT page_id, host, path, CASE {cases('rule')} END AS rule, n_strict, n_soft, weight,
  coalesce(CASE {cases('verdict')} END, CASE WHEN weight >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM b
"""


QUERIES = {"op3_url_filter": op3_url_filter}
SQL = {"op3_url_filter": _sql()}
