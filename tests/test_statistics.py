import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import forecast, profile, ranks
from shelfline.operators.ranks import dense_position, exact_quantiles


@pytest.mark.parametrize("seed,size,hot", [(1, 1, False), (2, 2, False), (3, 500, False), (4, 900, True)])
def test_exact_quantiles(spark, seed, size, hot):
    rng = random.Random(seed)
    data = {g: [5.0 if hot and rng.random() < 0.4 else float(rng.randrange(-400, 400)) for _ in range(size)] for g in "ab"}
    rows = [(g, v) for g, vs in data.items() for v in vs]
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").count()
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    for r in exact_quantiles(counts, "g", "v", "count", probabilities).collect():
        want = np.quantile(data[r.g], probabilities)
        assert np.allclose([r[f"q{i}"] for i in range(len(probabilities))], want)


def test_dense_position(spark):
    df = spark.range(1000).selectExpr("md5(cast(id as string)) as k").repartition(5)
    rows = dense_position(df, "k", "n").collect()
    assert [k for k, _ in sorted(((r.k, r.n) for r in rows), key=lambda x: x[1])] == sorted(r.k for r in rows)
    assert sorted(r.n for r in rows) == list(range(1000))


def test_profile_against_pandas(spark):
    rng = random.Random(5)
    pdf = pd.DataFrame({
        "n": [rng.gauss(0, 1) ** 3 for _ in range(300)],
        "k": [rng.randrange(5) for _ in range(300)],
        "one": [7] * 300,
        "t": [rng.choice("aabbbc") for _ in range(300)],
    })
    df = spark.createDataFrame(pdf)
    got = {r.column_name: r for r in profile.numeric_profile(df).collect()}
    for c in ("n", "k", "one"):
        s, r = pdf[c], got[c]
        assert np.allclose([r["min"], r["max"], r["mean"], r["median"], r["std"], r["p25"], r["p75"]],
                           [s.min(), s.max(), s.mean(), s.median(), s.std(), s.quantile(0.25), s.quantile(0.75)])
        assert r["skew"] == pytest.approx(round(float(s.skew()), 4), abs=1e-4)
        assert r["constant"] == (c == "one")
    text = {r.column_name: r for r in profile.categorical_profile(df).collect()}
    assert text["t"].top_value == "b" and text["t"].top_freq == int((pdf.t == "b").sum())
    assert text["k"].top_value is None and text["k"].uniques == 5 and text["n"].high_cardinality


def test_quantiles_of_unlike_columns_in_few_passes(spark, monkeypatch):
    rng = random.Random(8)
    pdf = pd.DataFrame({
        "prices": [round(rng.lognormvariate(3, 1), 2) for _ in range(5000)],
        "hot": [7.0] * 4000 + [rng.uniform(-1e6, 1e6) for _ in range(1000)],
        "scales": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(5000)],
        "close": [1 + k * 2.0 ** -52 for k in range(5000)],
        "extremes": [-1.7e308, 1.7e308] * 2500,
        "tiny": [5e-324 * (k % 3) for k in range(5000)],
        "zeros": [0.0, -0.0] * 2500,
    })
    df = spark.createDataFrame(pdf).repartition(3).cache()
    passes = []
    narrowed = ranks._narrowed
    monkeypatch.setattr(ranks, "_narrowed", lambda df, spans, wide: passes.append({s.column for s in spans}) or narrowed(df, spans, wide))
    probabilities = [0, 0.001, 0.25, 0.5, 0.77, 1]
    bounds = {c: (5000, float(pdf[c].min()), float(pdf[c].max())) for c in pdf}
    got = ranks.column_quantiles(df, bounds, probabilities)
    for c in pdf:
        values = sorted(pdf[c])
        for p, q in zip(probabilities, got[c]):
            lo, hi = values[math.floor(4999 * p)], values[math.ceil(4999 * p)]
            assert q == lo + (hi - lo) * (4999 * p - math.floor(4999 * p))
    assert sum("prices" in p for p in passes) <= 3 and sum("hot" in p for p in passes) <= 4 and len(passes) <= 20
    df.unpersist()


def test_profile_of_numbers_that_are_not_finite(spark):
    values = [1.0, 2.0, 3.0, float("inf"), None]
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "v double, k int")
    got = {r.column_name: r for r in profile.numeric_profile(df).collect()}
    assert (got["v"].median, got["v"].p25, got["v"]["max"]) == (2.5, 1.75, math.inf) and got["k"].median == 2.0


def test_numeric_profile_shuffles_bins_only(spark, folder):
    path = f"{folder}/t"
    spark.range(100_000).selectExpr("id", "id * 3.5D AS v", "cast(id as string) AS t").write.parquet(path)
    spans = [ranks._Span("v", 0.0, 349_996.5, 0, (50_000,))]
    cells = spark.read.parquet(path).select(spans[0].bin(False).alias("bin"))
    assert cells.distinct().count() <= ranks.BINS + 1
    got = {r.column_name: r.median for r in profile.numeric_profile(spark.read.parquet(path)).collect()}
    assert got == {"id": 49_999.5, "v": 174_998.25}


@pytest.mark.parametrize("values", [[None, None], [1.0], [1.0, 4.0], [1.0, 4.0, 9.0], [3.0, 3.0, None]])
def test_profile_of_few_values(spark, values):
    df = spark.createDataFrame([(v, "x") for v in values], "v double, t string")
    clean = pd.Series([v for v in values if v is not None], dtype=float)
    rows = profile.numeric_profile(df).collect()
    report = {r.column_name: r for r in profile.column_report(df).collect()}["v"]
    assert report.nulls == len(values) - len(clean) and report.uniques == clean.nunique()
    if not len(clean):
        assert rows == [] and report.badge == "all_null" and report.severity == "red"
        return
    r = rows[0]
    assert (r.median, r["min"]) == (clean.median(), clean.min())
    assert r["std"] == (pytest.approx(clean.std()) if len(clean) > 1 else None)
    assert r["skew"] == (pytest.approx(round(clean.skew(), 4)) if len(clean) > 2 else None)


def test_approximate_profile_is_close(spark):
    df = spark.range(1001).selectExpr("cast(id as double) as v")
    r = profile.approximate_numeric_profile(df).first()
    assert (r.p25, r.median, r.p75) == pytest.approx((250, 500, 750), abs=2)


def test_approximate_completeness(spark):
    df = spark.range(2000).selectExpr("id", "if(id % 4 = 0, null, id % 10) as k")
    got = {r.column_name: r for r in profile.approximate_completeness(df).collect()}
    assert got["id"].uniques == pytest.approx(2000, rel=0.05) and got["k"].nulls == 500


def test_table_summary(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None)], "k int, t string, z string")
    r = profile.table_summary("x", df).first()
    assert (r.row_count, r.column_count, r.numeric_columns, r.categorical_columns, r.null_cells,
            r.high_cardinality_columns) == (2, 3, 1, 2, 2, 1)


START = dt.date(2024, 1, 1)


def daily(spark, **series):
    rows = [(c, START + dt.timedelta(d), float(v)) for c, days in series.items() for d, v in days.items()]
    return spark.createDataFrame(rows, "product_category string, order_date date, daily_net_revenue double")


def test_densify(spark):
    got = forecast.densify(daily(spark, a={0: 5, 3: 7}, b={2: 1})).orderBy("product_category", "order_date").collect()
    assert [(r.product_category, r.order_date.day, r.daily_net_revenue) for r in got] == [
        ("a", 1, 5.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 7.0), ("b", 3, 1.0),
    ]


def test_moving_average(spark):
    dense = forecast.densify(daily(
        spark, two={0: 1, 1: 2}, three={0: 1, 1: 2, 2: 6}, nine={d: d + 1 for d in range(9)},
        negative={0: -5, 1: -5, 2: -1}, recovering={0: -50, 1: 1, 2: 4},
    ))
    got = {}
    for r in forecast.moving_average(dense).collect():
        got.setdefault(r.product_category, []).append((r.forecast_date, r.forecasted_net_revenue))
    assert set(got) == {"three", "nine", "negative", "recovering"}
    assert {v for _, v in got["three"]} == {3.0} and {v for _, v in got["nine"]} == {6.0}
    assert {v for _, v in got["negative"]} == {0.0} and {v for _, v in got["recovering"]} == {4.0}
    assert sorted(d for d, _ in got["three"]) == [dt.date(2024, 1, 4) + dt.timedelta(i) for i in range(30)]


def test_arima_falls_back_and_clips(spark):
    dense = forecast.densify(daily(
        spark, two={0: 1, 1: 2}, nine={d: 10 for d in range(9)}, ten={d: 10 + d % 3 for d in range(10)},
        falling={d: 200 - 20 * d for d in range(12)},
    ))
    got = {}
    for r in forecast.arima(dense).collect():
        got.setdefault((r.product_category, r.model), []).append(r.forecasted_net_revenue)
    assert set(got) == {("nine", "moving_average"), ("ten", "arima"), ("falling", "arima")}
    assert all(len(v) == 30 and min(v) >= 0 for v in got.values())


def simulated(phi, theta, size=6000):
    noise = np.random.default_rng(11).normal(size=size + 1)
    w = np.zeros(size)
    for t in range(1, size):
        w[t] = phi * w[t - 1] + noise[t] + theta * noise[t - 1]
    return w


@pytest.mark.parametrize("phi,theta", [(0.6, -0.3), (0.7, 0.4), (-0.6, -0.5), (-0.4, 0.5)])
def test_arma_fit(phi, theta):
    w = simulated(phi, theta)
    got = forecast.fit_arma(w)
    fitted, _ = forecast._arma_scan(w, *(np.array([x]) for x in got))
    true, _ = forecast._arma_scan(w, np.array([phi]), np.array([theta]))
    assert fitted[0] <= true[0]
    # Four standard errors of the maximum likelihood estimate; the pair is weakly
    # determined where the two parameters nearly cancel.
    error = abs((1 + phi * theta) / (phi + theta)) / np.sqrt(len(w))
    assert abs(got[0] - phi) < 4 * error * np.sqrt(1 - phi**2)
    assert abs(got[1] - theta) < 4 * error * np.sqrt(1 - theta**2)


def test_innovations_match_the_full_covariance():
    """The recursive likelihood against the multivariate normal density."""
    phi, theta, n = 0.5, 0.3, 12
    w = simulated(phi, theta, n)
    gamma = [(1 + 2 * phi * theta + theta**2) / (1 - phi**2)]
    gamma.append(phi * gamma[0] + theta)
    while len(gamma) < n:
        gamma.append(phi * gamma[-1])
    cov = np.array([[gamma[abs(i - j)] for j in range(n)] for i in range(n)])
    want = n * np.log(w @ np.linalg.solve(cov, w) / n) + np.linalg.slogdet(cov)[1]
    got, ahead = forecast._arma_scan(w, np.array([phi]), np.array([theta]))
    assert got[0] == pytest.approx(want)
    cross = np.array([phi ** (n - 1 - i) * gamma[1] for i in range(n)])
    assert ahead[0] == pytest.approx(cross @ np.linalg.solve(cov, w))


def test_constant_series_stays_constant():
    assert list(forecast.arima_111(np.full(20, 4.0), 3)) == [4.0, 4.0, 4.0]


def test_forecast_table_is_replaced_whole(spark, folder):
    table = forecast.ForecastTable(spark, f"{folder}/forecast")
    day = dt.date(2024, 1, 1)

    def made(*rows):
        return spark.createDataFrame([(c, day, v, "m") for c, v in rows], forecast.FORECAST_SCHEMA)

    at = [dt.datetime(2024, 1, 2, h, tzinfo=dt.timezone.utc) for h in range(3)]
    assert table.read().count() == 0
    assert table.write(made(("a/b", 1.0), ("c", 2.0)), at[0]) == 2
    assert table.write(made(("a/b", 3.0)), at[1]) == 1
    assert table.write(made(), at[2]) == 0
    got = table.read().select("*", F.unix_seconds("model_generated_at").alias("t")).collect()
    assert [(r.product_category, r.forecasted_net_revenue, r.t) for r in got] == [("a/b", 3.0, at[1].timestamp())]


def test_value_counts_by_column(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "1"), (None, "b", "1")], "k int, t string, z string")
    got = {(r.column_name, r.value): r.n for r in profile.value_counts(df).collect()}
    assert got == {
        ("k", "1"): 1, ("k", "2"): 1, ("k", None): 1, ("t", "a"): 2, ("t", "b"): 1, ("z", None): 1, ("z", "1"): 2,
    }
    few = profile.value_counts(df, ["z", "t"])
    assert few.columns == ["column_name", "value", "n"] and {r.column_name for r in few.collect()} == {"z", "t"}
