"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrat.scratch import TIDY, drop_scratch, materialize, scratch_path, settings, shared_dir  # noqa: F401
from quadrat.session import ship

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal id modulo modulus; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def same_columns(docs: DataFrame, out: DataFrame) -> DataFrame:
    """out with the columns of docs, in their order and types."""
    return out.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in docs.schema])


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, rows: int = 2000, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of so many rows and of so many bytes in a string or binary column, or of one longer row."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            done = size[at - 1] if at else 0
            end = min(at + rows, max(at + 1, int(np.searchsorted(size, done + most, "right"))))
            yield b.slice(at, end - at)
            at = end


def arrow_batches(spark: SparkSession, rows: int = 2000, most: int = 16 << 20) -> AbstractContextManager[None]:
    """Meanwhile queries that are run send rows to Python in batches of so many rows and about so many bytes."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": most})
