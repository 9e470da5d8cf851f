"""Custom operators against brute force on small fixtures: exact
percentiles, distributed per-group numbering and trailing statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from runlens.operators.quantiles import exact_percentiles
from runlens.operators.sequence import number_within, trailing_stats


def _skewed(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    # one hot group holding about a third of the rows
    g = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c", "d", "e"], n))
    v = rng.integers(0, 400, n).astype(float)
    t = rng.permutation(n)
    return pd.DataFrame({"g": g, "v": v, "t": t}), spark.createDataFrame(pd.DataFrame({"g": g, "v": v, "t": t})).repartition(7)


def test_exact_percentiles_match_numpy(spark):
    pdf, df = _skewed(spark)
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", [0.25, 0.5, 0.75, 0.95]).collect()}
    for g, grp in pdf.groupby("g"):
        for p, name in ((0.25, "p25"), (0.5, "p5"), (0.75, "p75"), (0.95, "p95")):
            assert abs(got[g][name] - np.percentile(grp["v"], p * 100)) < 1e-9, (g, p)
        assert got[g]["n"] == len(grp)


def test_exact_percentiles_single_value_group(spark):
    df = spark.createDataFrame([("x", 5.0)], "g string, v double")
    r = exact_percentiles(df, ["g"], "v", [0.25, 0.75], ["q1", "q3"]).collect()[0]
    assert (r["q1"], r["q3"]) == (5.0, 5.0)


def test_number_within_equals_row_number(spark):
    pdf, df = _skewed(spark)
    got = number_within(df, ["g"], ["t"]).select("g", "t", "rn")
    w = Window.partitionBy("g").orderBy("t")
    want = df.select("g", "t", (F.row_number().over(w) - 1).alias("rn"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_trailing_stats_equal_pandas_rolling(spark):
    pdf, df = _skewed(spark, n=800)
    numbered = number_within(df, ["g"], ["t"])
    got = {(r["g"], r["t"]): (r["prev_n"], r["prev_sum"]) for r in trailing_stats(numbered, ["g"], "v", 7).collect()}
    for g, grp in pdf.sort_values("t").groupby("g"):
        vals = grp["v"].to_numpy()
        for i, t in enumerate(grp["t"]):
            prev = vals[max(0, i - 7) : i]
            n, s = got[(g, t)]
            assert n == len(prev)
            assert (s is None and len(prev) == 0) or abs(s - prev.sum()) < 1e-9
