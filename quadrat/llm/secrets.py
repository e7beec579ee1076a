"""Secret scans over an incremental ledger of blobs.

Every distinct content is a blob, addressed by its SHA-256.  The ledger is a folder of two Parquet
tables: ``scanned`` (blob, rules) says which blob was scanned under which version of the rules, and
``findings`` (blob, rules, kind, start, end) what was found.  A scan takes only the pairs of blob and
rule version that the ledger lacks; findings are joined back to every path that holds the blob, now
or in history.  All of it is Spark functions; positions come from the lengths of what a pattern
matches and of what lies between the matches.

Findings are written before the pairs they belong to, each by one committed Parquet write, and readers
take distinct findings of scanned pairs: a run that dies between the two is simply done again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import scratch_path, table


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # without capturing groups other than `group`
    group: int = 0  # the group whose length counts
    at_least: int = 1
    one_of: tuple[str, ...] = ()  # strings of which every match holds one: a cheap test before the pattern

    def occurs(self, text: Column) -> Column:
        test = None
        for s in self.one_of:
            test = text.contains(s) if test is None else test | text.contains(s)
        return text.rlike(self.pattern) if test is None else test & text.rlike(self.pattern)


#: Fixed values of the query's contract: the three base kinds.  Quantifiers of access and hex carry the
#: least length: a run that is long enough is found from its start, and a shorter one holds no longer one.
BASE = (
    Rule("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8, ("=", ":")),
    Rule("access", r"AKIA[A-Z0-9]{12,}", one_of=("AKIA",)),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: What the method adds.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", one_of=("-----BEGIN ",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", one_of=("eyJ",)),
    Rule("prefixed", r"(?:ghp|gho|ghs|sk_live|sk_test|xoxb|xoxp)_[A-Za-z0-9]{16,}", one_of=("_",)),
    Rule("login", r"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9_.-]{1,64}:[^\x20\x09-\x0D/@:]{4,64}@", one_of=("://",)),
)
RULES = BASE + MORE
#: Goes up with every change of RULES; blobs are then scanned anew.
RULES_VERSION = 1

SPAN = "kind string, rank int, start int, end int"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule in a text, leftmost and without overlap, in code points, as an array of structs."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    gaps = F.split(text, rule.pattern, -1)
    n = F.size(hits)
    steps = F.zip_with(F.slice(gaps, 1, n), F.arrays_zip(hits.alias("h"), counted.alias("c")), lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h["h"]).alias("len"), (F.length(h["c"]) >= rule.at_least).alias("ok")))
    # the sum over what lies before; an array of few elements, for a text has few matches
    out = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), F.lit(None).cast(f"array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>").alias("found")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["len"]).alias("at"),
            F.when(s["ok"], F.concat(F.coalesce(acc["found"], F.array()), F.array(F.struct(F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"), (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["len"]).alias("end"))))).otherwise(acc["found"]).alias("found"),
        ),
        lambda acc: F.coalesce(acc["found"], F.array()),
    )
    return F.when(rule.occurs(text), out).otherwise(F.array().cast(f"array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>"))


def find_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text by start, then by the order of the rules."""
    both = F.concat(*[_spans(text, r, k) for k, r in enumerate(rules)])
    keyed = F.array_sort(F.transform(both, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")))


def suspect(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether any rule matches at all."""
    out = rules[0].occurs(text)
    for r in rules[1:]:
        out = out | r.occurs(text)
    return out


class Ledger:
    """What was scanned and found, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, rules int")

    def findings(self, version: int = RULES_VERSION) -> DataFrame:
        """(blob, spans) under a version of the rules; blobs without findings have no row."""
        f = self._read("findings", f"blob string, rules int, spans array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>")
        return f.where(F.col("rules") == version).drop("rules").dropDuplicates(["blob"])

    def update(self, docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, version: int = RULES_VERSION) -> None:
        """Scan the contents of docs that were never scanned under this version.

        Copies of a text within docs are scanned once: they meet in an aggregate that Spark combines
        before it shuffles, so a content that many rows have does not gather in one task.
        """
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        blobs = docs.select(text.alias("text")).select(F.sha2(F.col("text"), 256).alias("blob"), "text")
        known = self.scanned().where(F.col("rules") == version).select("blob").distinct()
        # only texts in which a rule matches at all are moved: the others need no more than their address
        some = blobs.where(suspect(F.col("text"), rules)).groupBy("blob").agg(F.first("text").alias("text"))
        fresh = some.join(known, "blob", "left_anti").select("blob", F.lit(version).alias("rules"), find_spans(F.col("text"), rules).alias("spans"))
        fresh.where(F.size("spans") > 0).write.mode("append").parquet(f"{self.path}/findings")
        blobs.select("blob").distinct().join(known, "blob", "left_anti").withColumn("rules", F.lit(version)).write.mode("append").parquet(f"{self.path}/scanned")


def _with_spans(docs: DataFrame, ledger: Ledger, text_col: str, version: int, keep: list[str]) -> DataFrame:
    """(_row, _spans): of each row of docs the columns keep, and what the ledger knows of its content."""
    blob = F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)
    keyed = docs.select(blob.alias("_blob"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"))
    found = ledger.findings(version).withColumnRenamed("blob", "_blob").withColumnRenamed("spans", "_spans")
    none = F.array().cast(found.schema["_spans"].dataType)
    return keyed.join(found, "_blob", "left").select("_row", F.coalesce("_spans", none).alias("_spans"))


def scan(docs: DataFrame, ledger: Ledger, text_col: str = "text", rules: tuple[Rule, ...] = RULES, version: int = RULES_VERSION, keep: list[str] | None = None) -> DataFrame:
    """(_row, _spans) of every row of docs: its columns (those in keep, or all), and what the ledger knows of its content after an update.

    Spans are structs (kind, rank, start, end), by start and then in the order of the rules; empty where
    nothing was found, for an empty text and for a null one.  Repeated rows stay, each with its spans.
    The columns kept are what is shuffled, so name only those that are needed.
    """
    ledger.update(docs, text_col, rules, version)
    return _with_spans(docs, ledger, text_col, version, keep or docs.columns)


def redact(docs: DataFrame, ledger: Ledger, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every span (overlapping ones as one) replaced by a mark; n_chars follows where docs has it.

    Texts without findings are left as they are; those in which no rule matches are not moved.
    """
    ledger.update(docs, text_col)
    found = F.coalesce(suspect(F.col(f"`{text_col}`")), F.lit(False))
    s = _with_spans(docs.where(found), ledger, text_col, RULES_VERSION, docs.columns)
    text = F.col(f"_row.`{text_col}`")
    merged = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.when(x["end"] <= acc["at"], acc).otherwise(F.struct(
            x["end"].alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    s = s.withColumn("_new", F.when(F.size("_spans") > 0, merged).otherwise(text))
    out = []
    for f in docs.schema:
        c = F.col(f"_row.`{f.name}`")
        if f.name == text_col:
            c = F.col("_new")
        elif f.name == "n_chars":
            c = F.when(F.size("_spans") > 0, F.length("_new")).otherwise(c).cast(f.dataType)
        out.append(c.alias(f.name))
    return docs.where(~found).unionByName(s.select(*out))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("_spans", lambda s: s["rank"] < len(BASE))
    return scanned.select(F.col(f"_row.`{id_col}`").alias(id_col), *[count(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents"), Ledger(spark, scratch_path(spark, "ledger")), keep=["doc_id"]))


def _sql() -> str:
    parts = []
    for k, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, '{r.kind}' AS kind, {k} AS rank, length(m) AS len, length(c) >= {r.at_least} AS ok,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, hits, gaps, i, hits[i] AS m, counted[i] AS c FROM (
    SELECT doc_id, hits, counted, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS hits, regexp_extract_all(text, '{p}', {r.group}) AS counted, string_split_regex(text, '{p}') AS gaps
      FROM d WHERE regexp_matches(text, '{p}'))))""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({' UNION ALL '.join(parts)}),
f AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || start::BIGINT || ':' || (start + len)::BIGINT, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}), '') AS base,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + len)::BIGINT, ',' ORDER BY start, rank) AS spans
  FROM s WHERE ok GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f USING (doc_id)
"""


QUERIES = {"op9_secret_scan": op9_secret_scan}
SQL = {"op9_secret_scan": _sql()}
