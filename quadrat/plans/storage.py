"""Queries that write, and read what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrat.plans.catalog import query
from quadrat.plans.relational import r6
from quadrat.scratch import scratch_path
from quadrat.sources import files, sinks


def summary(t, scale=1.0):
    return t.lineitem.groupBy(F.col("l_returnflag").alias("run_id"), F.col("l_linestatus").alias("scheme"), (F.col("l_linenumber") % 3).alias("seed")).agg(r6(F.avg("l_tax") * scale).alias("score"))


_SUMMARY = "SELECT l_returnflag AS run_id, l_linestatus AS scheme, l_linenumber % 3 AS seed, round(avg(l_tax) * {}, 6) AS score FROM lineitem {} GROUP BY ALL"


@query("K01", "SELECT s_suppkey, s_acctbal FROM supplier")
def _(t):
    path = scratch_path(t.spark, "k01")
    t.supplier.select("s_suppkey", "s_acctbal").sortWithinPartitions("s_suppkey").write.parquet(path)
    return t.spark.read.parquet(path)


@query("K02", _SUMMARY.format("1", ""))
def _(t):
    path = scratch_path(t.spark, "k02")
    sinks.write_run(summary(t), path)
    return t.spark.read.schema("seed int, score double, run_id string, scheme string").parquet(path)


@query("K03", f"{_SUMMARY.format('1', chr(32) + 'WHERE l_returnflag <> ' + chr(39) + 'R' + chr(39))} UNION ALL {_SUMMARY.format('2', 'WHERE l_returnflag = ' + chr(39) + 'R' + chr(39))}")
def _(t):
    path = scratch_path(t.spark, "k03")
    sinks.write_run(summary(t), path)
    sinks.upsert(summary(t, 2.0).where("run_id = 'R'"), path)
    return t.spark.read.schema("seed int, score double, run_id string, scheme string").parquet(path)


@query("K05", "SELECT DISTINCT l_suppkey AS tile, year(l_shipdate)::INT AS year, 'ok' AS status, NULL::VARCHAR AS error FROM lineitem WHERE l_quantity = 50 UNION ALL SELECT s_suppkey, NULL, 'failed', 'none' FROM supplier WHERE s_suppkey < 4")
def _(t):
    path, schema = scratch_path(t.spark, "k05"), "tile long, year int, status string, error string"
    done = t.lineitem.where("l_quantity = 50").select(F.col("l_suppkey").alias("tile"), F.year("l_shipdate").alias("year")).distinct()
    sinks.append_manifest(done.withColumn("status", F.lit("ok")), path, schema)
    sinks.append_manifest(t.supplier.where("s_suppkey < 4").select(F.col("s_suppkey").alias("tile"), F.lit("failed").alias("status"), F.lit("none").alias("error")), path, schema)
    return t.spark.read.schema(schema).parquet(path)


@query("K06", "WITH c AS (SELECT l_suppkey AS site, l_shipdate::DATE AS day, avg(CASE WHEN l_returnflag <> 'R' THEN l_tax END) FILTER (l_linenumber = 1) AS t1, avg(CASE WHEN l_returnflag <> 'R' THEN l_tax END) AS t5, avg(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) FILTER (l_linenumber = 1) AS q1, avg(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS q5, count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS n FROM lineitem GROUP BY ALL) SELECT site, day, 'tax' AS variable, 'centre' AS px, round(t1, 6) AS value, 1::BIGINT AS n_px FROM c WHERE t1 IS NOT NULL UNION ALL SELECT site, day, 'tax', 'mean5x5', round(t5, 6), n FROM c WHERE t5 IS NOT NULL UNION ALL SELECT site, day, 'quantity', 'centre', round(q1, 6), 1 FROM c WHERE q1 IS NOT NULL UNION ALL SELECT site, day, 'quantity', 'mean5x5', round(q5, 6), n FROM c WHERE q5 IS NOT NULL")
def _(t):
    """Series of each variable at the centre pixel and over the window, under folders of their own; masked observations have no row."""
    path = scratch_path(t.spark, "k06")
    clear = F.col("l_returnflag") != "R"
    obs = t.lineitem.select(F.col("l_suppkey").alias("site"), F.to_date("l_shipdate").alias("day"), (F.col("l_linenumber") == 1).alias("centre"), F.when(clear, F.col("l_tax")).alias("tax"), F.when(clear, F.col("l_quantity")).alias("quantity"))
    sinks.write_series(obs, path, ["site", "day"], ["tax", "quantity"])
    return t.spark.read.schema("site long, day date, value double, n_px long, variable string, px string").parquet(path).withColumn("value", r6("value"))


@query("S16", _SUMMARY.format("1", ""))
def _(t):
    path = scratch_path(t.spark, "s16")
    summary(t).write.partitionBy("run_id", "scheme").option("header", "true").csv(path)
    return files.keyed_by_path(t.spark, f"{path}/*/*/*.csv", "seed int, score double", r"run_id=([^/]+)/scheme=([^/]+)/", ["run_id", "scheme"]).select("run_id", "scheme", "seed", "score")


@query("S09", "SELECT DISTINCT year(o_orderdate)::VARCHAR AS year FROM orders")
def _(t):
    path = scratch_path(t.spark, "s09")
    t.orders.withColumn("y", F.year("o_orderdate")).select("y", "o_orderkey").write.partitionBy("y").parquet(path)
    return files.listed(t.spark, f"{path}/*/*.parquet", r"/y=(\d{4})/", "year").select("year").distinct()


@query("S01", "SELECT r_regionkey, r_name, CASE WHEN r_regionkey % 2 = 0 THEN r_regionkey / 2 END AS half FROM region")
def _(t):
    """A CSV table inside a zip file, read as strings and coerced; what is no number becomes null."""
    import io
    import zipfile

    rows = t.region.select("r_regionkey", "r_name").collect()  # the file is written here to be read
    lines = ["r_regionkey,r_name,half"] + [f"{r['r_regionkey']},{r['r_name']},{r['r_regionkey'] / 2 if r['r_regionkey'] % 2 == 0 else 'NA'}" for r in rows]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("data/regions.csv", "\n".join(lines))
    path = scratch_path(t.spark, "s01") + "/regions.zip"
    files.put(t.spark, path, out.getvalue())
    df = files.zipped_csv(t.spark, path, ["r_regionkey", "r_name", "half"])
    return files.coerced(df, {"r_regionkey": "int", "half": "double"})


@query("S04", "SELECT 'customer' AS \"table\", (SELECT count(*) FROM customer) AS n_rows, 0::BIGINT AS missing UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))")
def _(t):
    """Tables of a catalog under one key, each read once, and the ids that they lack."""
    c = files.Catalog(t.spark, t.path, "custkey")
    ids = c.table("customer", "c_custkey")
    c.table("orders", "o_custkey")
    if c.table("customer", "c_custkey") is not ids:
        raise AssertionError("a table was read twice")
    return c.coverage(ids)


@query("S05", "WITH e AS (SELECT vec_id // 25 AS plot, vec_id % 25 AS p, embedding FROM embeddings), x AS (SELECT plot, p, k, embedding[k + 1]::DOUBLE AS v FROM e, range(64) r(k)), l AS (SELECT plot, k, max(v) FILTER (p = 12) AS centre, avg(v) AS mean FROM x GROUP BY ALL) SELECT plot, 'centre' AS px, string_agg(round(centre * 1000000)::BIGINT::VARCHAR, ',' ORDER BY k) AS curve FROM l GROUP BY 1 UNION ALL SELECT plot, 'mean', string_agg(round(mean * 1000000)::BIGINT::VARCHAR, ',' ORDER BY k) FROM l GROUP BY 1")
def _(t):
    """Small cubes of curves as a compact table: the centre pixel and the mean of all."""
    p = F.col("vec_id") % 25
    e = t.embeddings.select(F.floor(F.col("vec_id") / 25).alias("plot"), F.floor(p / 5).cast("int").alias("y"), (p % 5).cast("int").alias("x"), "embedding")
    compact, _ = files.flattened(e, ["plot"], "embedding", (2, 2))
    text = F.array_join(F.transform("curve", lambda v: F.round(v * 1e6).cast("long").cast("string")), ",")
    # a cube without its centre has no curve there
    return compact.withColumn("curve", F.when(F.exists("curve", lambda v: v.isNotNull()), text))


def _sensors(t):
    x = t.lineitem.select((F.col("l_suppkey") % 20).alias("x"), F.col("l_linenumber").alias("y"), F.col("l_shipdate").alias("time"), "l_tax", "l_discount", "l_quantity", "l_extendedprice", "l_returnflag")
    return {s: x.where(F.col("l_returnflag") == s).drop("l_returnflag") for s in ("A", "N", "R")}


_WINDOW = "SELECT l_suppkey % 20 AS x, l_linenumber AS y, l_shipdate::DATE AS day, {} FROM lineitem WHERE l_suppkey % 20 BETWEEN 2 AND 9 AND l_linenumber BETWEEN 2 AND 5 AND year(l_shipdate) BETWEEN 1997 AND 1999 GROUP BY ALL"


@query("S06", _WINDOW.format("array_to_string(list_sort(list(DISTINCT l_returnflag)), '+') AS sensors, round(avg(l_tax), 9) AS l_tax, round(avg(l_discount), 9) AS l_discount, round(avg(l_quantity), 7) AS l_quantity, round(avg(l_extendedprice), 7) AS l_extendedprice"))
def _(t):
    """A window of all sensors' observations: bounds, years, one value for each pixel and solar day."""
    w = files.load_window(_sensors(t), (2, 2, 9, 5), (1997, 1999), ["l_tax", "l_discount", "l_quantity", "l_extendedprice"])
    return w.withColumns({"l_tax": F.round("l_tax", 9), "l_discount": F.round("l_discount", 9), "l_quantity": F.round("l_quantity", 7), "l_extendedprice": F.round("l_extendedprice", 7)})


@query("S07", _WINDOW.format("array_to_string(list_sort(list(DISTINCT l_returnflag)), '+') AS sensors, round(avg(l_tax), 9) AS l_tax"))
def _(t):
    """The same window with one band; no other is read."""
    return files.load_window(_sensors(t), (2, 2, 9, 5), (1997, 1999), ["l_tax"]).withColumn("l_tax", F.round("l_tax", 9))


@query("S19", "SELECT 'asset.bin' AS name, 4096::BIGINT AS length, 1::BIGINT AS copies")
def _(t):
    """A remote file fetched twice: the second time the copy of the right size is taken."""
    root = scratch_path(t.spark, "s19")
    files.put(t.spark, f"{root}/remote/asset.bin", bytes(4096))
    first = files.fetched(t.spark, f"{root}/remote/asset.bin", f"{root}/cache", 4096)
    if files.fetched(t.spark, f"{root}/remote/asset.bin", f"{root}/cache") != first:
        raise AssertionError("another copy")
    found = files.listed(t.spark, f"{root}/cache/*", r"/([^/]*)$", "name")
    return found.groupBy("name", "length").agg(F.count("*").alias("copies"))


@query("K04", "SELECT tile, year, r AS \"row\", c AS col, name, round(value::FLOAT::DOUBLE, 4) AS value FROM (SELECT l_suppkey % 10 AS tile, year(l_shipdate)::INT AS year, l_linenumber::BIGINT AS r, (l_suppkey // 10 % 5)::BIGINT AS c, avg(l_tax) AS tax, avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS quantity FROM lineitem GROUP BY ALL) UNPIVOT (value FOR name IN (tax, quantity))")
def _(t):
    """Tiles of rasters with named bands, written and read again."""
    path = scratch_path(t.spark, "k04")
    cells = t.lineitem.groupBy((F.col("l_suppkey") % 10).alias("tile"), F.year("l_shipdate").alias("year"), F.col("l_linenumber").cast("long").alias("row"), (F.floor(F.col("l_suppkey") / 10) % 5).alias("col")).agg(F.avg("l_tax").alias("tax"), F.avg(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("quantity"))
    sinks.write_tiles(cells, path, ["tax", "quantity"], {"crs": "EPSG:32719"})
    return sinks.read_tiles(t.spark, path, "tile long, year int").withColumn("value", F.round(F.col("value").cast("double"), 4)).select("tile", "year", "row", "col", "name", "value")


@query("K07", "SELECT '| ' || r_regionkey || ' | ' || r_name || ' |' AS line, r_regionkey + 3 AS place FROM region UNION ALL SELECT '| r_regionkey | r_name |', 1 UNION ALL SELECT '| --- | --- |', 2")
def _(t):
    """A small table as Markdown, line by line."""
    lines = sinks.markdown(t.region.select("r_regionkey", "r_name").orderBy("r_regionkey")).split("\n")
    return t.spark.createDataFrame(list(zip(lines, range(1, len(lines) + 1), strict=True)), "line string, place int")


@query("K08", "SELECT r_regionkey, r_name FROM region")
def _(t):
    """A version of a table under a name of its own, which a second write refuses."""
    from pyspark.errors import AnalysisException

    path = scratch_path(t.spark, "k08")
    at = sinks.write_versioned(t.region.select("r_regionkey", "r_name"), path, "_v2")
    try:
        sinks.write_versioned(t.region.select("r_regionkey", "r_name"), path, "_v2")
    except AnalysisException:
        return t.spark.read.parquet(at)
    raise AssertionError("a version was written twice")


@query("B10", "SELECT s_suppkey AS tile, (s_suppkey % 4)::INT AS chunk FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_linenumber = 2)")
def _(t):
    """What is missing, dealt to chunks that are worked on at once: an anti-join and a hash take the place of a chain of jobs."""
    from quadrat.sources import runs

    done = t.lineitem.where("l_quantity = 50 AND l_linenumber = 2").select(F.col("l_suppkey").alias("tile"))
    return runs.left_to_do(t.supplier.select(F.col("s_suppkey").alias("tile")), done, "tile").withColumn("chunk", (F.col("tile") % 4).cast("int"))


@query("B13", "SELECT count(*) AS rows, 0::BIGINT AS differ, 0.0::DOUBLE AS most FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem)")
def _(t):
    """The gate between two paths to the same numbers: a map's (written as tiles) and training's (one aggregate)."""
    from quadrat.sources import runs

    train = t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(F.avg("l_tax").alias("v"))
    path = scratch_path(t.spark, "b13")
    t.lineitem.select("l_suppkey", "l_linenumber", "l_tax").write.partitionBy("l_linenumber").parquet(path)
    tiles = t.spark.read.schema("l_suppkey long, l_tax double, l_linenumber int").parquet(path).groupBy("l_suppkey", "l_linenumber").agg((F.sum("l_tax") / F.count("*")).alias("v"))
    return runs.agreement(train, tiles, ["l_suppkey", "l_linenumber"], "v", 1e-9)


@query("S18", "SELECT 'run' || k AS run_id, p_partkey, p_size AS obs, round(p_retailprice / 50, 4) AS pred FROM part, (VALUES (0), (2)) v(k) WHERE p_partkey % 4 = k")
def _(t):
    """Out-of-fold tables of a glob of runs: confirmation runs are left out by name, tables that lack a column by their schema."""
    root = scratch_path(t.spark, "s18")
    for k, name in enumerate(("run0", "run1_s10", "run2", "run3")):
        part = t.part.where(F.col("p_partkey") % 4 == k).select("p_partkey", F.col("p_size").alias("obs"), F.round(F.col("p_retailprice") / 50, 4).alias("pred"))
        (part.drop("pred") if k == 3 else part).write.parquet(f"{root}/{name}/lodo/oof")
    return files.tables_of(t.spark, f"{root}/*/lodo/oof", r"/([^/]+)/lodo/oof", "run_id", ["p_partkey", "obs", "pred"], without="_s10")
