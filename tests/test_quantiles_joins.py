"""Distributed exact quantiles and the skew-safe keyed join."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txlens.operators.joins import keyed_join
from txlens.operators.quantiles import grouped_quantiles, quantiles


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_exact_quantiles_match_numpy(spark, parts):
    rng = np.random.default_rng(parts)
    v = np.round(rng.exponential(10, 2000), 1)  # many duplicates
    df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(parts)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    got = quantiles(df, "v", probs)
    assert np.allclose(got, np.percentile(v, [p * 100 for p in probs]), rtol=0, atol=1e-9)


def test_grouped_quantiles(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 1000), "v": rng.normal(size=1000)})
    pdf.loc[pdf.index < 700, "g"] = 0  # a hot group
    got = grouped_quantiles(spark.createDataFrame(pdf), ["g"], "v", [0.25, 0.5, 0.9]).toPandas().set_index("g")
    for g, grp in pdf.groupby("g"):
        exp = np.percentile(grp["v"], [25, 50, 90])
        assert np.allclose(got.loc[g, ["q250", "q500", "q900"]].to_numpy(float), exp, atol=1e-12)


def test_keyed_join_hot_key_equals_plain_join(spark):
    big = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                                   F.col("id"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    weights = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    a = keyed_join(big, small, ["k"], "left", weights=weights).orderBy("id").toPandas()
    b = big.join(small, "k", "left").select("k", "id", "v").orderBy("id").toPandas()
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))
