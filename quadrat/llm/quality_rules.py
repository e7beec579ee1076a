"""Quality rules: a decision list learned by sequential covering.

Statistics of every text are computed by Spark functions alone.  From the statistics of labelled
documents a list of rules is learned: a rule is a conjunction of thresholds that is grown condition
by condition (best gain of information) and then pruned on rows set aside, and the rows that it covers
are taken out before the next rule is grown.  The list becomes one ordered CASE expression.  Rules
describe documents of low quality; what no rule covers is kept.

``max_labelled`` bounds the labelled rows that the learner takes (those of the smallest hash of the
id); only their numbers reach the driver.  Everything else covers all rows and whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.llm.common import table, words

MAX_LABELLED = 4000
#: A learned rule must be right for this share of the rows that it covers, or it is not taken.
MIN_PRECISION = 0.95
MIN_COVER = 8
#: The learned conditions look at these; each is a number for any text, 0 for an empty one.
FEATURES = ("symbol_share", "upper_share", "exclaim_share", "dup_line_share", "repeat_word_share", "distinct_share", "mean_word", "pipe_share")


def _neighbours(a: Column, n: Column, by: int) -> Column:
    """Elements by+1 .. n of an array, so that position i holds what stood at i+by."""
    return F.slice(a, by + 1, F.greatest(n - by, F.lit(0)))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and FEATURES) of every row.

    A null text counts as empty: all counts are 0.  Rows are kept as they are, repeated ids included.
    Three-word windows are compared by 64-bit hashes.  No row needs another, so there is no shuffle;
    within a row the cost is that of sorting its windows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # explode() of one element keeps Spark from computing the arrays anew for each use
    a = docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text"), F.explode(F.array(F.transform(words(text), lambda w: F.xxhash64(w)))).alias("_h"))
    n = F.size("_h")
    from_ = lambda by: F.slice("_h", by + 1, F.greatest(n - 2, F.lit(0)))
    windows = F.zip_with(F.zip_with(from_(0), from_(1), lambda x, y: F.xxhash64(x, y)), from_(2), lambda x, y: F.xxhash64(x, y))
    a = a.select("_id", "_text", n.alias("n_words"), F.size(F.array_distinct("_h")).alias("_distinct"), F.explode(F.array(windows)).alias("_win"))
    # only where some window comes again are windows put beside each other
    again = F.size(F.array_distinct("_win")) < F.size("_win")
    placed = F.when(again, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    a = a.select("_id", "_text", "n_words", "_distinct", F.explode(F.array(F.struct(placed.alias("s"), lines.alias("l")))).alias("_x"))
    s, m = F.col("_x.s"), F.size("_x.s")
    twins = F.zip_with(F.slice(s, 1, F.greatest(m - 1, F.lit(0))), _neighbours(s, m, 1), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))
    starts = F.array_sort(F.array_distinct(F.flatten(twins)))
    covered = F.aggregate(
        starts, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("sum")),
        lambda acc, i: F.struct(i.alias("last"), (acc["sum"] + F.least(F.lit(3), i - acc["last"])).alias("sum")), lambda acc: acc["sum"],
    )
    count = lambda kind: F.length(F.regexp_replace("_text", f"[^{kind}]+", "")).cast("long")
    b = a.select(
        "_id", F.col("n_words").cast("long").alias("n_words"), "_distinct",
        (F.length("_text") - count(r"\x20\x09-\x0D")).alias("word_chars"),
        count("#*$%&|<>").alias("n_symbols"),
        (F.size("_x.l") - F.size(F.array_distinct("_x.l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_x.l").alias("_lines"), count("!").alias("_exclaim"), count("|").alias("_pipe"), count("A-Z").alias("_upper"),
    )
    share = lambda x, y: F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(y).cast("double")), F.lit(0.0))
    return b.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "word_chars").alias("symbol_share"), share("_upper", "word_chars").alias("upper_share"),
        share("_exclaim", "n_words").alias("exclaim_share"), share("n_dup_lines", "_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_word_share"), share("_distinct", "n_words").alias("distinct_share"),
        share("word_chars", "n_words").alias("mean_word"), share("_pipe", "n_words").alias("pipe_share"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _tally(rule: Rule, rows: list) -> tuple[int, int]:
    """Covered rows of low quality, and covered others."""
    low = [bad for row, bad in rows if _covers(rule, row)]
    return sum(low), len(low) - sum(low)


def _grow(rows: list, features: tuple[str, ...], max_conditions: int, bins: int = 32) -> Rule:
    rule: Rule = ()
    left = rows
    while len(rule) < max_conditions:
        p0, n0 = sum(bad for _, bad in left), sum(not bad for _, bad in left)
        if not p0 or not n0:
            break
        best, best_gain = None, 0.0
        for f in features:
            values = sorted({row[f] for row, _ in left})
            cuts = values[:-1] if len(values) <= bins else sorted({values[len(values) * k // bins] for k in range(1, bins)})
            for cut in cuts:
                p = sum(bad for row, bad in left if row[f] > cut)
                n = sum(not bad for row, bad in left if row[f] > cut)
                for above, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                    if not pp:
                        continue
                    gain = pp * (math.log2(pp / (pp + nn)) - math.log2(p0 / (p0 + n0)))
                    if gain > best_gain + 1e-9:
                        best, best_gain = Condition(f, above, cut), gain
        if best is None:
            break
        rule += (best,)
        left = [x for x in left if best.holds(x[0])]
    return rule


def _prune(rule: Rule, rows: list) -> Rule:
    """Drop last conditions while that does not lower (p - n) / (p + n) on the rows set aside."""
    def worth(r: Rule) -> float:
        p, n = _tally(r, rows)
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn_rules(rows: list[tuple[dict, bool]], features: tuple[str, ...] = FEATURES, max_rules: int = 12, max_conditions: int = 3, min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[Rule]:
    """A decision list for low quality from (statistics, is low) rows; empty without rows of both kinds.

    Of every three rows one is set aside for pruning; the order of rows is that of the caller, so the
    same rows give the same list.
    """
    rules: list[Rule] = []
    left = list(rows)
    while len(rules) < max_rules and any(bad for _, bad in left):
        grow, aside = [x for i, x in enumerate(left) if i % 3], left[::3]
        rule = _prune(_grow(grow, features, max_conditions), aside)
        p, n = _tally(rule, left)
        if not rule or p < min_cover or p < min_precision * (p + n):
            break
        rules.append(rule)
        left = [x for x in left if not _covers(rule, x[0])]
    return rules


def rejected_by(rules: list[Rule]) -> Column:
    """The number of the first rule that covers a row, from 1; null where none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Learn from documents (doc_id, text) with labels (doc_id, quality); rows without either are not used.

    The bounded sample is taken from the labels first, so what is broadcast and what reaches the driver
    are at most max_labelled rows of numbers, whatever the size of the tables.
    """
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_lid")).agg(F.min("quality").alias("_label"))
    chosen = own.orderBy(F.xxhash64("_lid"), "_lid").limit(max_labelled)
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_lid"), "left_semi")
    stats = text_statistics(some).join(F.broadcast(chosen), F.col("doc_id") == F.col("_lid"))
    got = stats.groupBy("_lid", "_label").agg(*[F.max(f).alias(f) for f in FEATURES]).collect()
    got.sort(key=lambda r: r["_lid"])
    return learn_rules([({f: r[f] for f in FEATURES}, r["_label"] == 0) for r in got])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Statistics of every row, base_failed, the number of the rule that rejects it (or null), and kept.

    Without labels of both kinds the learned list is empty and only the base decides.  A null text is
    an empty one, and fails the base.  Repeated rows are judged one by one; a null id stays null.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rules = fit(own, labels, max_labelled)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = text_statistics(own).withColumns({"base_failed": failed, "rule": rejected_by(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).withColumnRenamed("doc_id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that the learned list does not reject.

    The verdict is computed beside the row, so no join is needed.  The base of op5 is left out here: it
    would also drop short texts that nothing is wrong with.
    """
    rules = fit(docs, labels)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    stats = text_statistics(packed.select("_row", F.col("_row.text").alias("_t")), "_row", "_t")
    return stats.where(rejected_by(rules).isNull()).select("_row.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")


QUERIES = {"op5_quality_rules": op5_quality_rules}
SQL: dict[str, str] = {}
