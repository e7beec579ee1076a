"""Quotas do not depend on how the cells are dealt to tasks."""

from quadrat.plans import catalog


def test_shares_of_a_half(spark, sf_dir):
    """At sf0.01 a band has 32.5 of 1500 for each cell, so 19.5 of 900: the last digit of the sum decides."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    seen = set()
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for parts in (1, 2, 3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            seen.add(tuple(sorted((r["cell"], r["quota"]) for r in catalog.QUERIES["G16"](spark, sf_dir).collect())))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(seen) == 1
