"""Queries of curves as images, of their inverse, and of augmentation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrat.operators import images as I
from quadrat.operators import series as S
from quadrat.plans.catalog import query

N = 64


def whole(c, places: int = 4):
    """Numbers of an array, times a power of ten and rounded, as text."""
    return F.array_join(F.transform(c, lambda v: F.round(v * 10.0**places).cast("long").cast("string")), ",")


def whole_sql(expr: str, places: int = 4) -> str:
    return f"array_to_string(list_transform({expr}, lambda v: round(v * {10.0**places!r}::DOUBLE)::BIGINT), ',')"


def curves(t, add: float = 0.0):
    """(vec_id, c) with the whole curve."""
    e = F.transform("embedding", lambda v: v.cast("double") + add if add else v.cast("double"))
    return t.embeddings.select("vec_id", F.explode(F.array(e)).alias("c"))  # one element: computed once


def _l_system(order: int) -> list[int]:
    """Cells along the Hilbert curve, by rewriting rules and a turtle."""
    path = "A"
    for _ in range(order):
        path = "".join({"A": "-BF+AFA+FB-", "B": "+AF-BFB-FA+"}.get(c, c) for c in path)
    x = y = 0
    dx, dy = 1, 0
    out = [0]
    for c in path:
        if c == "F":
            x, y = x + dx, y + dy
            out.append(y * 2**order + x)
        elif c in "+-":
            dx, dy = (-dy, dx) if c == "-" else (dy, -dx)
    if out[1] == 1:  # along x first: the other of the two mirrored curves
        out = [c % 2**order * 2**order + c // 2**order for c in out]
    return out


_CELL = {"reshape": "c", "serpentine": "CASE WHEN (c // 8) % 2 = 0 THEN c ELSE c // 8 * 8 + 7 - c % 8 END"}
_HILBERT = str([_l_system(3).index(c) for c in range(64)])


@query("I01", f"SELECT vec_id, {whole_sql('list_transform(range(81), lambda c: embedding[c % 64 + 1]::DOUBLE)', 6)} AS image FROM embeddings")
def _(t):
    """A square of side 9 from 64 values: the curve begins anew in the cells that are left."""
    return curves(t).select("vec_id", whole(S.folded(F.col("c"), S.reshape_order(9), N), 6).alias("image"))


@query("I03", f"SELECT vec_id, {whole_sql(f'list_transform({_HILBERT}, lambda k: embedding[k + 1]::DOUBLE)', 6)} AS image FROM embeddings")
def _(t):
    return curves(t).select("vec_id", whole(I.make_transform("hilbert")(F.col("c"), N), 6).alias("image"))


_SCALED = "s AS (SELECT vec_id, list_transform(e, lambda v: greatest(-1, least(1, (2 * v - list_max(e) - list_min(e)) / (list_max(e) - list_min(e))))) AS x FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))"
_GAF = "list_concat(flatten(list_transform(x, lambda a: list_transform(x, lambda b: a * b - sqrt(1 - a * a) * sqrt(1 - b * b)))), flatten(list_transform(x, lambda a: list_transform(x, lambda b: sqrt(1 - a * a) * b - a * sqrt(1 - b * b)))))"


@query("I04", f"WITH {_SCALED} SELECT vec_id, {whole_sql(_GAF)} AS image FROM s")
def _(t):
    return curves(t).select("vec_id", whole(I.make_transform("gaf")(F.col("c"), N)).alias("image"))


_NDI = "flatten(list_transform(e, lambda a: list_transform(e, lambda b: CASE WHEN abs(a + b) > 1e-8 THEN (a - b) / (a + b) ELSE 0 END)))"
_PLUS = "(SELECT vec_id, list_transform(embedding::DOUBLE[], lambda v: v + 2.0::DOUBLE) AS e FROM embeddings)"


@query("I06", f"SELECT vec_id, {whole_sql(_NDI)} AS image FROM {_PLUS}")
def _(t):
    return curves(t, 2.0).select("vec_id", whole(I.make_transform("ndi")(F.col("c"), N)).alias("image"))


@query("I05", """WITH x AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE AS x FROM embeddings, range(64) r(i)), ed AS (SELECT DISTINCT vec_id, edge FROM (SELECT vec_id, unnest(quantile_cont(x, [0.2, 0.4, 0.6, 0.8])) AS edge FROM x GROUP BY 1)),
q AS (SELECT vec_id, i, count(edge) FILTER (edge <= x) AS q FROM x JOIN ed USING (vec_id) GROUP BY vec_id, i), m AS (SELECT a.vec_id, a.q AS qa, b.q AS qb, count(*)::DOUBLE AS n FROM q a JOIN q b ON a.vec_id = b.vec_id AND b.i = a.i + 1 GROUP BY ALL), s AS (SELECT vec_id, qa, sum(n) AS s FROM m GROUP BY ALL)
SELECT a.vec_id, array_to_string(list(round(coalesce(n / s, 0) * 10000.0::DOUBLE)::BIGINT ORDER BY a.i, b.i), ',') AS image FROM q a JOIN q b USING (vec_id) LEFT JOIN m ON m.vec_id = a.vec_id AND m.qa = a.q AND m.qb = b.q LEFT JOIN s ON s.vec_id = a.vec_id AND s.qa = a.q GROUP BY 1""")
def _(t):
    return curves(t).select("vec_id", whole(I.make_transform("mtf")(F.col("c"), N)).alias("image"))


@query("I07")
def _(t):
    return curves(t).select("vec_id", whole(I.make_transform("cwt")(F.col("c"), N), 6).alias("image"))


@query("I08", """WITH y AS (SELECT vec_id, k, c, embedding[3 * k + c + 1]::DOUBLE AS y FROM embeddings, range(20) r(k), range(6) s(c)), d AS (SELECT vec_id, k, c, y - avg(y) OVER (PARTITION BY vec_id, c) AS d FROM y),
v AS (SELECT a.vec_id, 0 AS ch, a.c AS p, b.c AS q, sum(a.d * b.d) / 19 AS v FROM d a JOIN d b USING (vec_id, k) GROUP BY ALL UNION ALL SELECT a.vec_id, 1, a.c, b.c, sum(CASE WHEN a.k <> b.k THEN a.d * b.d / (pi() * (a.k - b.k)) ELSE 0 END) / 19 FROM d a JOIN d b USING (vec_id) GROUP BY ALL)
SELECT vec_id, array_to_string(list(round(v * 1000000.0::DOUBLE)::BIGINT ORDER BY ch, p, q), ',') AS image FROM v GROUP BY 1""")
def _(t):
    return curves(t).select("vec_id", whole(I.make_transform("cos2d")(F.col("c"), N), 6).alias("image"))


@query("I09", """WITH c AS (SELECT vec_id, f, m, sum(w * x * cos(2 * pi() * f * j / 16)) AS re, sum(w * x * sin(2 * pi() * f * j / 16)) AS im FROM (SELECT vec_id, f, m, j, pow(sin(pi() * j / 16), 2) AS w, coalesce(CASE WHEN 4 * m + j >= 8 THEN embedding[4 * m + j - 7]::DOUBLE END, 0) AS x FROM embeddings, range(9) a(f), range(17) b(m), range(16) d(j)) GROUP BY ALL)
SELECT vec_id, array_to_string(list(round(sqrt(re * re + im * im) / 8 * 1000000.0::DOUBLE)::BIGINT ORDER BY f, m), ',') AS image FROM c GROUP BY 1""")
def _(t):
    return curves(t).select("vec_id", whole(I.make_transform("spectrogram")(F.col("c"), N), 6).alias("image"))


@query("I10", "SELECT vec_id, name, channels, rows, cells FROM embeddings, (VALUES ('reshape', 1, 8, 64), ('serpentine', 1, 8, 64), ('hilbert', 1, 8, 64), ('gaf', 2, 64, 8192), ('ndi', 1, 64, 4096), ('mtf', 1, 64, 4096), ('cwt', 1, 24, 1536), ('cos2d', 2, 6, 72), ('spectrogram', 1, 9, 153)) v(name, channels, rows, cells)")
def _(t):
    """What each transform of the registry makes of each curve."""
    c = curves(t)
    out = []
    for name in I.TRANSFORMS:
        channels, rows = I.SHAPES[name](N)
        out.append(c.select("vec_id", F.lit(name).alias("name"), F.lit(channels).alias("channels"), F.lit(rows).alias("rows"), F.size(I.make_transform(name)(F.col("c"), N)).alias("cells")))
    return reduce(DataFrame.unionByName, out)


@query("I11", f"SELECT vec_id // 5 AS plot, string_agg({whole_sql(f'list_transform(list_transform(range(64), lambda c: {_CELL['serpentine']}), lambda k: embedding[(k + 49) % 64 + 1]::DOUBLE)', 6)}, ';' ORDER BY vec_id) AS image FROM embeddings GROUP BY 1")
def _(t):
    """Five indices of a plot as channels of one image, each curve rolled back to the calendar and folded as a serpentine."""
    own = curves(t).select("vec_id", I.make_transform("serpentine")(S.rolled(F.col("c"), F.lit(15.0)), N).alias("image"))
    channels = own.groupBy(F.floor(F.col("vec_id") / 5).alias("plot")).agg(F.sort_array(F.collect_list(F.struct("vec_id", whole("image", 6).alias("i")))).alias("x"))
    return channels.select("plot", F.array_join(F.transform("x", lambda x: x["i"]), ";").alias("image"))


_COLUMN_MEAN = "list_transform(range(64), lambda j: list_sum(list_transform(range(64), lambda i: abs({0}[i * 64 + j + 1]))) / 64)"


@query("I12", f"""WITH {_SCALED}, g AS (SELECT vec_id, {_GAF} AS image FROM s), d AS (SELECT vec_id, {_NDI} AS image FROM {_PLUS})
SELECT vec_id, name, {whole_sql("embedding::DOUBLE[]")} AS profile FROM embeddings, (VALUES ('reshape'), ('serpentine'), ('hilbert')) v(name)
UNION ALL SELECT vec_id, 'ndi', {whole_sql(_COLUMN_MEAN.format('image'))} FROM d
UNION ALL SELECT vec_id, 'gaf', {whole_sql(_COLUMN_MEAN.format('mean'))} FROM (SELECT vec_id, list_transform(range(1, 4097), lambda k: (abs(image[k]) + abs(image[k + 4096])) / 2) AS mean FROM g)""")
def _(t):
    """The profile of steps of an image of each kind: exact for the foldings, the marginal mean for the fields."""
    out = []
    for name in ("reshape", "serpentine", "hilbert", "ndi", "gaf"):
        c = curves(t, 2.0 if name == "ndi" else 0.0)
        image = c.select("vec_id", F.explode(F.array(I.make_transform(name)(F.col("c"), N))).alias("image"))
        out.append(image.select("vec_id", F.lit(name).alias("name"), whole(I.unfold(F.col("image"), name, N)).alias("profile")))
    return reduce(DataFrame.unionByName, out)


def u_sql(*parts: str) -> str:
    return f"((('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)"


def n_sql(*parts: str) -> str:
    return f"(sqrt(-2 * ln({u_sql(*parts, "'r'")})) * cos(2 * pi() * {u_sql(*parts, "'a'")}))"


@query("I13", f"""WITH p AS (SELECT vec_id, embedding::DOUBLE[] AS c, {n_sql("'7'", 'vec_id', "'shift'")} * 0.5 AS shift, (2 * {u_sql("'7'", 'vec_id', "'scale'")} - 1) * 0.05 AS scale, (2 * {u_sql("'7'", 'vec_id', "'lift'")} - 1) * 0.02 AS lift, (2 * {u_sql("'7'", 'vec_id', "'tilt'")} - 1) * 0.03 AS tilt, {u_sql("'7'", 'vec_id', "'hit'")} < 0.6 AS hit FROM embeddings),
x AS (SELECT *, i, i - shift - 64 * floor((i - shift) / 64) AS pos FROM p, range(64) r(i)), y AS (SELECT vec_id, i, CASE WHEN hit THEN (c[floor(pos)::BIGINT % 64 + 1] * (1 - (pos - floor(pos))) + c[(floor(pos)::BIGINT + 1) % 64 + 1] * (pos - floor(pos))) * (1 + scale) + lift + tilt * (i / 63 - 0.5) + 0.01 * {n_sql("'7'", 'vec_id', 'i')} ELSE c[i + 1] END AS v FROM x)
SELECT vec_id, array_to_string(list(round(v * 1000000.0::DOUBLE)::BIGINT ORDER BY i), ',') AS curve FROM y GROUP BY 1""")
def _(t):
    out = I.augmented(t.embeddings.select("vec_id", "embedding"), "vec_id", "embedding", 7, slope=0.03, share=0.6)
    return out.select("vec_id", whole("embedding", 6).alias("curve"))


@query("I14", f"""WITH e AS (SELECT vec_id, vec_id // 50 AS batch FROM embeddings), a AS (SELECT vec_id, batch, row_number() OVER (PARTITION BY batch ORDER BY vec_id) AS i FROM e), b AS (SELECT vec_id AS partner, batch, row_number() OVER (PARTITION BY batch ORDER BY md5('3|' || batch || '|' || vec_id), vec_id) AS i FROM e),
w AS (SELECT batch, list_filter(list_transform(range(1, 65), lambda i: {{'x': pow({u_sql("'3'", 'batch', "'u'", 'i')}, 5), 'y': pow({u_sql("'3'", 'batch', "'v'", 'i')}, 5)}}), lambda p: p.x + p.y <= 1 AND p.x + p.y > 0)[1] AS p FROM (SELECT DISTINCT batch FROM e))
SELECT vec_id, batch, partner, round(coalesce(p.x / (p.x + p.y), 0.5), 8) AS weight FROM a JOIN b USING (batch, i) JOIN w USING (batch)""")
def _(t):
    e = t.embeddings.select("vec_id", F.floor(F.col("vec_id") / 50).alias("batch"))
    return I.mixed(e, "vec_id", "batch", 3).withColumn("weight", F.round("weight", 8))


@query("I15", f"""WITH e AS (SELECT vec_id // 25 AS plot, vec_id % 25 AS pixel, embedding::DOUBLE[] AS c FROM embeddings), m AS (SELECT plot, list(m ORDER BY i) AS mean FROM (SELECT plot, i, avg(c[i + 1]) AS m FROM e, range(64) r(i) GROUP BY ALL) GROUP BY 1),
d AS (SELECT plot, arg_min(pixel, md5('5|' || plot || '|' || pixel) || pixel) AS pixel FROM e GROUP BY 1)
SELECT plot, CASE WHEN plot * 7 % 40 <= 30 THEN pixel END AS pixel, CASE WHEN plot * 7 % 40 <= 30 THEN {whole_sql('c', 6)} ELSE {whole_sql('mean', 6)} END AS curve FROM d JOIN m USING (plot) JOIN e USING (plot, pixel)""")
def _(t):
    e = t.embeddings.select(F.floor(F.col("vec_id") / 25).alias("plot"), (F.col("vec_id") % 25).alias("pixel"), F.transform("embedding", lambda v: v.cast("double")).alias("curve"))
    step = e.select("plot", F.posexplode("curve").alias("i", "v")).groupBy("plot", "i").agg(F.avg("v").alias("v"))
    plots = step.groupBy("plot").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("curve")).withColumn("anchor_sd", (F.col("plot") * 7 % 40).cast("double"))
    return I.sampled_pixels(e, plots, 5).withColumn("curve", whole("curve", 6))


@query("I16", f"SELECT vec_id, array_to_string(list_transform(range(8), lambda r: {whole_sql(f'list_transform(list_transform(range(r * 8, r * 8 + 8), lambda c: {_CELL['serpentine']}), lambda k: embedding[k + 1]::DOUBLE)', 6)}), ';') AS image FROM embeddings")
def _(t):
    """The input of a model: one channel of rows of a serpentine."""
    image = I.make_transform("serpentine")(F.col("c"), N)
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: whole(F.slice(F.col("image"), r * 8 + 1, F.lit(8)), 6))
    return curves(t).select("vec_id", image.alias("image")).select("vec_id", F.array_join(rows, ";").alias("image"))
