"""Margins of error against plain numpy and pandas, and their properties."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arealis.functions.numbers import divide
from arealis.operators import moe_closed as mc
from arealis.operators import moe_replicate as mr
from arealis.operators import moe_simulate as ms
from arealis.operators import shares

RNG = np.random.default_rng(3)


def long(spark, ests, moes):
    rows = [
        (f"a{i}", f"v{j}", None if np.isnan(ests[i, j]) else float(ests[i, j]), float(moes[i, j]))
        for i in range(ests.shape[0])
        for j in range(ests.shape[1])
    ]
    return spark.createDataFrame(rows, "geoid string, variable string, est double, moe double")


def by_area(df):
    return {r["geoid"]: (r["est"], r["moe"]) for r in df.collect()}


def test_sum_counts_only_the_largest_margin_of_zero_estimates(spark):
    ests = RNG.integers(0, 4, (30, 5)).astype(float)
    ests[3] = 0
    moes = RNG.uniform(0, 9, (30, 5))
    got = by_area(mc.sum_with_moe(long(spark, ests, moes), ["geoid"]))
    for i in range(30):
        zero = moes[i][ests[i] == 0]
        square = (moes[i][ests[i] != 0] ** 2).sum() + (zero.max() if len(zero) else 0) ** 2
        assert got[f"a{i}"] == pytest.approx((ests[i].sum(), np.sqrt(square)))


def test_sum_of_missing_estimates_is_zero_and_keeps_their_margins(spark):
    ests, moes = np.array([[np.nan, np.nan]]), np.array([[3.0, 4.0]])
    assert by_area(mc.sum_with_moe(long(spark, ests, moes), ["geoid"]))["a0"] == (0.0, 5.0)


def test_sum_of_one_variable_keeps_its_margin(spark):
    got = by_area(mc.sum_with_moe(long(spark, np.array([[7.0]]), np.array([[2.5]])), ["geoid"]))
    assert got["a0"] == (7.0, 2.5)


def test_proportion_falls_back_to_the_ratio_formula(spark):
    df = spark.createDataFrame(
        [("root", 5.0, 10.0, 4.0, 2.0), ("negative", 9.0, 10.0, 1.0, 8.0),
         ("zero", 10.0, 10.0, 3.0, 3.0), ("empty", 1.0, 0.0, 1.0, 1.0)],
        "geoid string, n double, d double, m1 double, m2 double",
    )
    got = by_area(mc.with_proportion(df, "n", "d", "m1", "m2"))
    ratio = by_area(mc.with_ratio(df, "n", "d", "m1", "m2"))
    assert got["root"] == pytest.approx((0.5, np.sqrt(16 - 0.25 * 4) / 10))
    assert got["negative"] == ratio["negative"]
    assert got["zero"] == ratio["zero"]
    assert got["empty"] == (None, None) == ratio["empty"]


# --- replicates ------------------------------------------------------------------------


def replicates(spark, ests, reps):
    """``ests (areas, variables)``, ``reps (areas, variables, 80)``."""
    rows = [
        (f"a{i}", f"v{j}", float(ests[i, j]), 0.0, 0.0, [float(x) for x in reps[i, j]])
        for i in range(ests.shape[0])
        for j in range(ests.shape[1])
    ]
    return spark.createDataFrame(
        rows, "geoid string, variable string, est double, moe double, se double, reps array<double>"
    )


@pytest.fixture(scope="module")
def table():
    ests = RNG.integers(0, 5, (25, 2)).astype(float)
    ests[0] = 0  # zero over zero
    ests[1] = (3, 0)  # infinite
    reps = np.maximum(ests[:, :, None] + RNG.integers(-2, 3, (25, 2, 80)), 0).astype(float)
    reps[0] = 0
    return ests, reps


def plain_ratio(ests, reps):
    """The same computation with pandas: infinite results are 0, missing ones skipped."""
    with np.errstate(all="ignore"):
        est = pd.Series(ests[:, 0] / ests[:, 1]).replace([np.inf, -np.inf], 0)
        rep = pd.DataFrame(reps[:, 0] / reps[:, 1]).replace([np.inf, -np.inf], 0)
    moe = 1.645 * np.sqrt(((rep.sub(est, axis=0)) ** 2).sum(axis=1) * 4 / 80)
    moe[est == 0] = np.nan
    moe[est.isna()] = np.nan
    return est.fillna(0), moe


@pytest.mark.parametrize("form", ["columns", "pandas"])
def test_function_of_replicates(spark, table, form):
    ests, reps = table
    df = replicates(spark, ests, reps)
    if form == "columns":
        out = mr.estimate(df, ["v0", "v1"], lambda v: divide(v["v0"], v["v1"]))
    else:
        out = mr.estimate_pandas(df, ["v0", "v1"], lambda t: t["v0"] / t["v1"])
    got, (est, moe) = by_area(out), plain_ratio(ests, reps)
    for i in range(len(ests)):
        e, m = got[f"a{i}"]
        assert e == pytest.approx(est[i])
        assert m is None if np.isnan(moe[i]) else m == pytest.approx(moe[i])


@pytest.mark.parametrize("form", ["columns", "pandas"])
def test_area_that_lacks_a_variable_has_no_margin(spark, table, form):
    df = replicates(spark, *table).where("NOT (geoid = 'a5' AND variable = 'v1')")
    run = mr.estimate if form == "columns" else mr.estimate_pandas
    got = by_area(run(df, ["v0", "v1"], lambda v: v["v0"] + v["v1"]))
    assert len(got) == 25
    assert got["a5"] == (0.0, None)


def test_replicates_equal_to_the_estimate_have_no_margin(spark):
    df = replicates(spark, np.full((1, 1), 6.0), np.full((1, 1, 80), 6.0))
    row = mr.moe_of_arrays(df).first()
    assert row["moe"] == 0.0 and row["steady"]


def test_collapse_sums_each_replicate(spark, table):
    ests, reps = table
    df = replicates(spark, ests, reps).withColumn("all", F.lit("x"))
    row = mr.collapse(df, ["all", "variable"]).where("variable = 'v1'").first()
    assert row["est"] == ests[:, 1].sum()
    assert row["reps"] == pytest.approx(list(reps[:, 1].sum(axis=0)))


def test_zero_counts_take_k_of_the_population_band(spark):
    df = replicates(spark, np.zeros((6, 1)), np.zeros((6, 1, 80)))
    sizes = [0, 4999, 5000, 19999, 49999, 50000]
    base = spark.createDataFrame([(f"a{i}", float(s)) for i, s in enumerate(sizes)], "geoid string, base double")
    weights = spark.createDataFrame([("1", 9.0)], "fips string, avg_weight double")
    got = by_area(mr.estimate(df, ["v0"], lambda v: v["v0"], "count", True, base, "01", weights))
    for i, k in enumerate([4, 4, 8, 10, 18, 22]):
        assert got[f"a{i}"] == pytest.approx((0.0, 1.645 * np.sqrt(9.0 * k)))


def test_wrong_zero_rule_is_an_error(spark, table):
    df = replicates(spark, *table)
    with pytest.raises(ValueError):
        mr.estimate(df, ["v0"], lambda v: v["v0"], zeros="all")
    with pytest.raises(ValueError):
        mr.estimate(df, ["v0"], lambda v: v["v0"], zeros="count")


def test_results_do_not_shuffle_again_after_the_variables_are_together(spark, table):
    out = mr.moe_of_rows(mr.function_rows(replicates(spark, *table), ["v0", "v1"], lambda v: v["v0"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# --- simulation ------------------------------------------------------------------------------


def test_without_error_there_is_no_margin(spark):
    df = long(spark, RNG.uniform(1, 9, (5, 2)), np.zeros((5, 2)))
    out = ms.simulate(df, ["v0", "v1"], lambda v: v["v0"] + v["v1"], seed=1).collect()
    assert all(r["moe"] == 0 for r in out)


@pytest.mark.parametrize("rep_style", [True, False])
def test_margin_of_one_variable_is_about_its_own(spark, rep_style):
    df = long(spark, np.array([[500.0]]), np.array([[40.0]]))
    out = ms.simulate(df, ["v0"], lambda v: v["v0"], sims=4000, rep_style=rep_style, seed=5)
    assert out.first()["moe"] == pytest.approx(40.0, rel=0.05)


def test_draws_do_not_depend_on_partitions(spark):
    df = long(spark, RNG.uniform(5, 9, (40, 2)), RNG.uniform(1, 2, (40, 2)))
    func = lambda v: v["v0"] * v["v1"]
    one = by_area(ms.simulate(df.coalesce(1), ["v0", "v1"], func, seed=5))
    many = by_area(ms.simulate(df.repartition(13), ["v0", "v1"], func, seed=5))
    assert one.keys() == many.keys()
    assert all(one[k] == pytest.approx(many[k]) for k in one)


def test_interval_takes_order_statistics(spark):
    df = long(spark, np.array([[50.0]]), np.array([[9.0]]))
    options = dict(sims=77, rep_style=False, seed=2)
    cells = ms.simulated_cells(df, ["v0"], **options).toPandas()["s0"].to_numpy()
    want = (np.percentile(cells, 95, method="higher") - np.percentile(cells, 5, method="lower")) / 2
    out = ms.simulate(df, ["v0"], lambda v: v["v0"], analytic=False, **options)
    assert out.first()["moe"] == pytest.approx(want)


def test_not_finite_results_leave_no_margin_unless_replaced(spark):
    df = long(spark, np.array([[5.0, 0.0]]), np.array([[1.0, 1.0]]))
    func = lambda v: divide(v["v0"], v["v1"])
    assert ms.simulate(df, ["v0", "v1"], func, seed=1).first()["moe"] is None
    assert ms.simulate(df, ["v0", "v1"], func, seed=1, replace_na=0, rep_style=False).first()["moe"] == 0


@pytest.mark.parametrize(
    "bad",
    [
        dict(ignore_zeros="some"),
        dict(ignore_zeros="partial"),
        dict(truncate=1),
        dict(whole="yes"),
        dict(single_draw=None),
        dict(analytic=False),
        dict(replace_na=True),
    ],
)
def test_bad_options_are_errors(spark, bad):
    df = long(spark, np.array([[5.0]]), np.array([[1.0]]))
    with pytest.raises(ValueError):
        ms.simulate(df, ["v0"], lambda v: v["v0"], **bad)


def test_index_over_areas_equals_81_separate_runs(spark):
    """The dissimilarity of every version of the table, one after the other."""
    rng = np.random.default_rng(3)
    n = 40
    tables = rng.integers(0, 50, (81, n, 2)).astype(float)
    rows = []
    for i in range(n):
        for k, v in enumerate("ab"):
            rows.append((f"{i:03d}", v, float(tables[0, i, k]), [float(x) for x in tables[1:, i, k]]))
    df = spark.createDataFrame(rows, "geoid string, variable string, est double, reps array<double>").repartition(6)

    def index(t):
        return 0.5 * np.abs(t[:, 0] / t[:, 0].sum() - t[:, 1] / t[:, 1].sum()).sum()

    def margin(some):
        values = [index(tables[r][some]) for r in range(81)]
        return values[0], 1.645 * math.sqrt(4 / 80 * sum((v - values[0]) ** 2 for v in values[1:]))

    row = shares.dissimilarity_with_moe(df, "a", "b").first()
    assert np.allclose((row["est"], row["moe"]), margin(np.arange(n)))
    by = {"part": F.substring("geoid", 3, 1)}
    got = {r["part"]: (r["est"], r["moe"]) for r in shares.dissimilarity_with_moe(df, "a", "b", by).collect()}
    assert len(got) == 10
    for part, values in got.items():
        assert np.allclose(values, margin(np.array([i for i in range(n) if f"{i:03d}"[2] == part])))


def test_index_of_a_total_that_is_zero_is_missing(spark):
    rows = [("1", "a", 0.0, [0.0] * 80), ("1", "b", 1.0, [1.0] * 80)]
    df = spark.createDataFrame(rows, "geoid string, variable string, est double, reps array<double>")
    row = shares.dissimilarity_with_moe(df, "a", "b").first()
    assert row["est"] is None or row["est"] == 0.0
