"""Runs and their results: identity, what is left to do, and work whose failures are rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def run_id(family: str, tag: str, **parts: Column) -> Column:
    """The name of a run from what defines it: family_tag__part__part, empty parts left out."""
    named = [F.when(p != "", p) for p in parts.values()]
    return F.concat_ws("__", F.lit(f"{family}_{tag}"), *named)


def with_metadata(pooled: DataFrame, meta: DataFrame, keys: list[str]) -> DataFrame:
    """pooled with the columns of meta, of which each key is taken once."""
    return pooled.join(meta.dropDuplicates(keys), keys, "left")


def left_to_do(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done.select(key).distinct(), key, "left_anti")


def waves(items: DataFrame, done: DataFrame, key: str, size: int) -> DataFrame:
    """(key, wave): items that are not done, so many in a wave, in the order of the key; they are tiles or jobs, few beside what they hold."""
    left = left_to_do(items.select(key), done, key)
    return left.withColumn("wave", F.floor((F.row_number().over(Window.orderBy(key)) - 1) / size))


def run_matrix(spark: SparkSession, jobs: list[str], work: Callable[[str], Any], done: Callable[[str], bool]) -> DataFrame:
    """(job, status) of jobs run one after another from the driver: skipped if done, else done or failed."""
    rows = []
    for job in jobs:
        if done(job):
            rows.append((job, "skipped"))
            continue
        try:
            work(job)
            rows.append((job, "done"))
        except Exception:  # noqa: BLE001  a failure is a row
            rows.append((job, "failed"))
    return spark.createDataFrame(rows, "job string, status string")


def fan_out(items: DataFrame, key: str, value: str, work: Callable[[Any, Any], int]) -> DataFrame:
    """(key, status, value): work(key, value) of each row in tasks; status is ok or error, and the value of an error null."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, v in zip(b[key], b[value], strict=True):
                try:
                    rows.append((k, "ok", work(k, int(v))))
                except Exception:  # noqa: BLE001
                    rows.append((k, "error", None))
            yield pd.DataFrame(rows, columns=[key, "status", "value"]).astype({"value": "Int64"})

    return items.select(key, value).mapInPandas(run, f"{key} string, status string, value long")


def per_tile(rows: DataFrame, key: str, work: Callable[[pd.DataFrame], dict], results: str) -> DataFrame:
    """(key, status, results, n, error): work on all rows of each tile; an error gives its message and null results."""
    names = [r.split()[0] for r in results.split(", ")]
    kind = rows.schema[key].dataType.simpleString()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        base = {key: pdf[key].iloc[0], "n": len(pdf)}
        try:
            out = base | {"status": "ok", "error": None} | work(pdf)
        except Exception as e:  # noqa: BLE001
            out = base | {"status": "failed", "error": str(e)} | dict.fromkeys(names)
        return pd.DataFrame([out])[[key, "status", *names, "n", "error"]]

    return rows.groupBy(key).applyInPandas(one, f"{key} {kind}, status string, {results}, n long, error string")


def agreement(a: DataFrame, b: DataFrame, keys: list[str], value: str, within: float) -> DataFrame:
    """(rows, differ, most): rows of either table, those whose values differ by more than `within` or that one lacks, and the largest difference, in units of `within`, rounded down."""
    x, y = a.select(*keys, F.col(value).alias("_a")), b.select(*keys, F.col(value).alias("_b"))
    gap = F.abs(F.col("_a") - F.col("_b"))
    off = F.coalesce(gap > within, F.lit(True)) & ~(F.col("_a").isNull() & F.col("_b").isNull())
    return x.join(y, keys, "full_outer").agg(F.count("*").alias("rows"), F.count(F.when(off, 1)).alias("differ"), F.floor(F.max(gap) / within).cast("double").alias("most"))
