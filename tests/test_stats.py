"""Column helpers, exact quantiles/ranks and distribution tails."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylytics.functions import dist
from staylytics.functions.columns import capped, currency_to_double, round_half_away, safe_corr, weekend_flag
from staylytics.operators import anova as A
from staylytics.operators.quantiles import code, exact_quantiles, exact_quantiles_multi, group_quantiles, value_ranks
from staylytics.plans import marts


def test_f_tail_table_values():
    # 5% critical values of F from printed tables
    assert dist.f_sf(4.10, 2, 10) == pytest.approx(0.05, abs=5e-4)
    assert dist.f_sf(3.10, 3, 20) == pytest.approx(0.05, abs=5e-4)
    assert dist.f_sf(1e6, 3, 1000) == pytest.approx(0.0, abs=1e-300)


def test_studentized_range_table_values():
    assert dist.studentized_range_ppf(0.95, 3, 10) == pytest.approx(3.877, abs=2e-3)
    assert dist.studentized_range_ppf(0.95, 5, 20) == pytest.approx(4.232, abs=2e-3)
    assert dist.studentized_range_sf(3.877, 3, 10) == pytest.approx(0.05, abs=1e-3)


def test_exact_quantiles_match_numpy_and_partitioning(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 50.0, 3000), 1)          # many ties
    vals[:1000] = 42.0                                        # one value holds a third of rows
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    for parts in (1, 8):
        got = {r["prob"]: r["value"] for r in exact_quantiles(df.repartition(parts), "x", probs).collect()}
        for p in probs:
            assert got[p] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-9)


def test_value_ranks_prefix(spark):
    df = spark.createDataFrame([(v,) for v in [3.0, 1.0, 1.0, 2.0, 3.0, 3.0]], "x double")
    r = {row["value"]: (row["cnt"], row["cum_before"]) for row in value_ranks(df, "x").collect()}
    assert r == {1.0: (2, 0), 2.0: (1, 2), 3.0: (3, 3)}


def test_code_has_the_order_and_bits_of_doubles(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.integers(0, 1 << 64, 4000, dtype=np.uint64).view(np.float64), 2.0 ** np.arange(-1074, 1024), 2.0 ** np.arange(-1022, 1024) * (1 - 2 ** -53),
                        [0.0, -0.0, np.inf, -np.inf, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 1 / 3, np.nan]])
    got = {r["i"]: r["c"] for r in spark.createDataFrame(list(enumerate(x.tolist())), "i int, x double").select("i", code(F.col("x")).alias("c")).collect()}
    for i, v in enumerate(x):
        bits = int(np.array(abs(v)).view(np.int64))
        assert got[i] == (None if np.isnan(v) else -bits if v < 0 else bits), v


def test_value_ranks_of_many_values(spark):
    df = spark.range(200_000).select(((F.col("id") * 7919) % 50_021 / 7.0 - 3000).alias("x"))
    got = value_ranks(df, "x").orderBy("value").collect()
    x, n = np.unique(((np.arange(200_000) * 7919) % 50_021) / 7.0 - 3000, return_counts=True)
    assert [r["value"] for r in got] == x.tolist() and [r["cnt"] for r in got] == n.tolist()
    assert [r["cum_before"] for r in got] == (np.cumsum(n) - n).tolist()


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [("$1,200.00", 2.5, 1.0, 5.0, dt.date(2024, 12, 7)), ("abc", -2.5, 1.0, 7.0, dt.date(2024, 12, 9)),
         (None, 0.125, 1.0, 9.0, None)],
        "t string, v double, c double, y double, d date")
    rows = df.select(currency_to_double("t").alias("p"), round_half_away("v", 0).alias("r0"),
                     round_half_away("v", 2).alias("r2"), weekend_flag("d").alias("w"),
                     capped(F.col("y"), 6).alias("cap")).collect()
    assert [r["p"] for r in rows] == [1200.0, None, None]
    assert [r["r0"] for r in rows] == [3.0, -3.0, 0.0]
    assert [r["w"] for r in rows] == [True, False, False]
    assert [r["cap"] for r in rows] == [5.0, 6.0, 6.0]
    assert df.agg(safe_corr("c", "y").alias("k")).first()["k"] is None   # constant column -> NULL
    assert df.agg(safe_corr("v", "y").alias("k")).first()["k"] == pytest.approx(np.corrcoef([2.5, -2.5, 0.125], [5, 7, 9])[0, 1])


def test_exact_quantiles_multi(spark):
    rng = np.random.default_rng(5)
    a = np.round(rng.normal(10, 3, 2000), 2)
    b = rng.integers(0, 7, 2000).astype(float)
    rows = [(float(x), float(y) if i % 5 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.01, 0.5, 0.99]
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles_multi(df, ["a", "b"], probs).collect()}
    bb = np.array([y for _, y in rows if y is not None])
    for p in probs:
        assert got[("a", p)] == pytest.approx(float(np.percentile(a, p * 100)), abs=1e-9)
        assert got[("b", p)] == pytest.approx(float(np.percentile(bb, p * 100)), abs=1e-9)


def test_group_quantiles_exact_beyond_sketch_size(spark):
    df = spark.range(1_000_000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 1_000_003 / 7.0).alias("v"))
    names = {"p01": 0.01, "p25": 0.25, "median": 0.5, "p99": 0.99, "top": 1.0}
    got = group_quantiles(df, ["g"], "v", names)
    rows = {r["g"]: r for r in got.collect()}
    want = df.groupBy("g").agg(*[F.expr(f"percentile_disc({p}) within group (order by v)").alias(n) for n, p in names.items()]).collect()
    assert {r["g"]: [r[n] for n in names] for r in want} == {g: [r[n] for n in names] for g, r in rows.items()}
    one = group_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert one == df.select(F.expr("percentile_disc(0.5) within group (order by v)")).first()[0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan and "percentile_approx" not in plan
    assert "ReusedExchange" in plan  # the counted values are shuffled once


def test_group_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", float("nan")), ("c", 2.0)], "g string, v double")
    assert [tuple(r) for r in group_quantiles(df, ["g"], "v", {"m": 0.5}).collect()] == [("c", 2.0)]
    far = spark.createDataFrame([(float("inf"),), (float("-inf"),), (-0.0,), (0.0,), (5e-324,)], "v double")
    assert tuple(group_quantiles(far, [], "v", {"a": 0.0, "m": 0.5, "z": 1.0}).first()) == (float("-inf"), 0.0, float("inf"))
    assert group_quantiles(df.limit(0), [], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("digits", [2, 6])
def test_round_half_away_of_large_values(spark, digits):
    df = spark.createDataFrame([(1e13,), (2.5e17,), (-2.5e17,), (1e300,), (0.125,)], "v double")
    got = [r[0] for r in df.select(round_half_away("v", digits)).collect()]
    assert got[:4] == [1e13, 2.5e17, -2.5e17, 1e300] and got[4] == (0.13 if digits == 2 else 0.125)


def test_studentized_range_has_one_formula_for_all_df():
    limit = dist.studentized_range_sf(3.5, 4, float("inf"))  # the distance to it falls as 1 / df
    far = [(dist.studentized_range_sf(3.5, 4, df) - limit) * df for df in (1e3, 9e4, 1e5, 1.1e5, 1e6, 1e8)]
    assert far == pytest.approx([0.6238] * 6, rel=1e-3)
    assert dist.studentized_range_ppf(0.95, 3, 60) == pytest.approx(3.399, abs=2e-3)


def test_rows_without_group_take_no_part(spark):
    rows = [("a", float(i)) for i in range(1, 9)] + [("b", float(3 * i)) for i in range(1, 9)] + [(None, 500.0)] * 4
    dl = spark.createDataFrame([(g, p) for g, p in rows], "room_type string, avg_price_next_30_days double")
    d = A.anova_input(dl, "room_type")
    t = A.anova_table(d).first()
    assert (t["k"], t["n"]) == (2, 16)
    assert A.kruskal(d).first()["n"] == 16 and A.tukey_pairs(d).count() == 1 and A.tukey_hsd(d).count() == 1


def test_calendar_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "cal")
    spark.range(400).select(F.col("id").alias("listing_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                            F.lit(True).alias("is_available"), F.lit(1.0).alias("price_usd")).write.parquet(path)
    m = marts.calendar_metrics(spark.read.parquet(path))
    assert m.count() == 31
    plan = m._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(date" in line or "date >= ScalarSubquery" in line or "(date#" in line and ">=" in line for line in pushed), plan


def test_significant_pairs_are_those_the_full_table_rejects(spark):
    r = np.random.default_rng(2)
    rows = [(f"g{j}", float(v)) for j in range(9) for v in r.normal(j * 0.35, 1.0, 30 + 7 * j)]
    d = spark.createDataFrame(rows, "g string, y double")
    table = A.tukey_hsd(d).collect()
    assert tuple(A.tukey_significant(d).first()) == (sum(t["reject"] for t in table), 36) and 0 < sum(t["reject"] for t in table) < 36
    assert tuple(A.tukey_significant(d.where("g = 'g0'")).first()) == (0, 0)
    lone = spark.createDataFrame([("a", 1.0), ("b", 5.0)], "g string, y double")  # nothing left within groups
    assert tuple(A.tukey_significant(lone).first()) == (0, 1)
    assert tuple(A.tukey_significant(d.where("false")).first()) == (0, 0)
