import zipfile

import numpy as np
import pandas as pd
import pytest

from quadrat.operators import models as M
from quadrat.sources import files, sinks


def test_zipped_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/x.csv", 'id,species,Value\np1,NA,"1,5"\np2,"a ""b""",2.5\n')
        z.writestr("read.me", "no")
    df = files.zipped_csv(spark, f"file://{tmp_path}/*.zip", ["id", "species", "Value", "lacking"])
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("p1", "NA", "1,5", None), ("p2", 'a "b"', "2.5", None)]
    assert [r["Value"] for r in files.coerced(df, {"Value": "double"}).orderBy("id").collect()] == [None, 2.5]


def test_declared_tables(spark, tmp_path):
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, v double").write.parquet(f"file://{tmp_path}/t")
    assert [r["v"] for r in files.declared(spark, f"file://{tmp_path}/t", "id int, v double", ["id"]).orderBy("id").collect()] == [None, 1.0]
    spark.createDataFrame([(2, 3.0)], "id int, v double").write.mode("append").parquet(f"file://{tmp_path}/t")
    with pytest.raises(ValueError):
        files.declared(spark, f"file://{tmp_path}/t", "id int, v double", ["id"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, None)], "a int, b double")
    assert sinks.markdown(df.orderBy("a")) == "| a | b |\n| --- | --- |\n| 1 | 0.500 |\n| 2 |  |"
    with pytest.raises(ValueError):
        sinks.append_manifest(df, f"file://{tmp_path}/m", "a int")
    assert sinks.write_versioned(df, f"file://{tmp_path}/v", "_2").endswith("v_2")
    with pytest.raises(Exception):
        sinks.write_versioned(df, f"file://{tmp_path}/v", "_2")


def test_models(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 3))
    x[:, 2] = x[:, 0] * 0.9 + 0.1 * x[:, 2]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    got = np.array([[r["pc1"], r["pc2"]] for r in M.principal_components(df, "id", ["a", "b", "c"], 2).orderBy("id").collect()])
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    w = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert got.var(axis=0, ddof=1) == pytest.approx(w[:2]) and abs(np.corrcoef(got.T)[0, 1]) < 1e-9 and z.shape == (300, 3)
    d = rng.random(400) * 2
    pairs = spark.createDataFrame([(float(a), float(1 - np.exp(-(0.2 + 0.8 * a)))) for a in d], "dx double, y double")
    assert M.fit_dissimilarity(pairs, ["dx"], "y", 80) == pytest.approx([0.2, 0.8], abs=0.1)
    assert M.wilcoxon(pd.DataFrame({"d": [1, 2, 3, 4, 5, 6, 7, 8]})) < 0.02 and M.wilcoxon(pd.DataFrame({"d": [1, -1, 2, -2]})) == 1
