"""Names of taxa."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(name: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(name), "áéíóúñ", "aeioun")


def genus(name: Column) -> Column:
    """The first word of a binomial; null where there is none."""
    g = F.regexp_extract(name, r"^([A-Z][a-z-]+) [a-z-]{2,}", 1)
    return F.when(g != "", g)


def folded_name(name: Column, prefixes: list[str], suffix: str, literals: dict[str, str]) -> Column:
    """A name without a prefix and a suffix (a pattern), with some spellings replaced, folded."""
    out = name
    for p in prefixes:
        out = F.regexp_replace(out, f"^{p}", "")
    out = F.regexp_replace(out, f"{suffix}$", "")
    for a, b in literals.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return fold(out)
