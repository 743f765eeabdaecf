"""Margins of error: closed formulas, replicates, simulation."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import ids
from arealis.functions.numbers import divide
from arealis.operators import moe_closed as mc
from arealis.operators import moe_replicate as mr
from arealis.operators import moe_simulate as ms
from arealis.operators.shares import dissimilarity_with_moe
from workload.tables import (
    CELLS_SQL,
    REPLICATE_ROWS_SQL,
    SHARES_SQL,
    cells,
    replicate_cells,
    replicate_lines,
    shares,
    table,
    text,
)

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def rounded(df, digits=6, *cols):
    for c in cols or ("est", "moe"):
        df = df.withColumn(c, F.round(c, digits))
    return df


ZERO_RULE_SQL = """
  round(sum(est), 6) AS est,
  round(sqrt(sum(CASE WHEN est = 0 THEN 0 ELSE moe * moe END)
       + pow(coalesce(max(CASE WHEN est = 0 THEN moe END), 0), 2)), 6) AS moe
"""


@query("sum_moe_over_variables", f"WITH {CELLS_SQL} SELECT geoid, {ZERO_RULE_SQL} FROM cells GROUP BY geoid")
def _(spark, sf):
    return rounded(mc.sum_with_moe(cells(spark, sf), ["geoid"]))


@query(
    "sum_moe_over_areas",
    f"""WITH {CELLS_SQL} SELECT n_regionkey::varchar AS state, variable, {ZERO_RULE_SQL}
    FROM cells JOIN supplier ON s_suppkey::varchar = geoid
    JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""",
)
def _(spark, sf):
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    parents = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("geoid"),
        F.col("n_regionkey").cast("string").alias("state"),
    )
    joined = cells(spark, sf).join(parents, "geoid")
    return rounded(mc.sum_with_moe(joined, ["state", "variable"]))


@query(
    "ratio_moe",
    f"""WITH {SHARES_SQL} SELECT geoid, round(n / nullif(d, 0), 6) AS est,
    round(sqrt(m1*m1 + (n/nullif(d, 0))*(n/nullif(d, 0))*m2*m2) / nullif(d, 0), 9) AS moe FROM shares""",
)
def _(spark, sf):
    out = mc.with_ratio(shares(spark, sf), "n", "d", "m1", "m2").select("geoid", "est", "moe")
    return rounded(rounded(out, 6, "est"), 9, "moe")


@query(
    "proportion_moe",
    f"""WITH {SHARES_SQL}, p AS (SELECT *, n / nullif(d, 0) AS p FROM shares)
    SELECT geoid, round(p, 6) AS est,
    round(CASE WHEN m1*m1 - p*p*m2*m2 > 0 THEN sqrt(m1*m1 - p*p*m2*m2)
               ELSE sqrt(m1*m1 + p*p*m2*m2) END / nullif(d, 0), 9) AS moe FROM p""",
)
def _(spark, sf):
    out = mc.with_proportion(shares(spark, sf), "n", "d", "m1", "m2").select("geoid", "est", "moe")
    return rounded(rounded(out, 6, "est"), 9, "moe")


# --- replicates ------------------------------------------------------------------------


@query(
    "replicate_moe",
    f"""WITH {REPLICATE_ROWS_SQL}, s AS (
      SELECT geoid, r, sum(est) AS est, sum(rep) AS rep FROM rep_rows GROUP BY 1, 2)
    SELECT geoid, est, round(1.645 * sqrt(4.0e0/80 * sum((rep - est) * (rep - est))), 4) AS moe
    FROM s GROUP BY geoid, est""",
)
def _(spark, sf):
    lines = replicate_lines(spark, sf, F.col("l_suppkey").cast("string").alias("geoid"))
    out = mr.moe_of_arrays(mr.collapse(lines, ["geoid"])).select("geoid", "est", "moe")
    return rounded(out, 4, "moe")


@query(
    "replicate_moe_of_parents",
    f"""WITH {REPLICATE_ROWS_SQL}, s AS (
      SELECT lpad(s_nationkey::varchar, 3, '0') AS geoid, variable, r, sum(est) AS est, sum(rep) AS rep
      FROM rep_rows JOIN supplier ON s_suppkey::varchar = geoid GROUP BY 1, 2, 3)
    SELECT geoid, variable, est,
           round(1.645 * sqrt(4.0e0/80 * sum((rep - est) * (rep - est))), 4) AS moe
    FROM s GROUP BY geoid, variable, est""",
)
def _(spark, sf):
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("geoid"), text("s_nationkey", 3).alias("county")
    )
    joined = replicate_cells(spark, sf).join(supplier, "geoid")
    parents = mr.collapse(joined, [F.col("county").alias("geoid"), F.col("variable")])
    out = mr.moe_of_arrays(parents, ["geoid", "variable"]).drop("steady")
    return rounded(out, 4, "moe")


# the ratio of two variables whose denominator is zero in places
RATIO_SQL = f"""{REPLICATE_ROWS_SQL}, wide AS (
  SELECT geoid, r, max(CASE WHEN variable = 'A' THEN est END) AS ae,
         max(CASE WHEN variable = 'A' THEN rep END) AS ar,
         max(CASE WHEN variable = 'R' THEN est END) AS re,
         max(CASE WHEN variable = 'R' THEN rep END) AS rr
  FROM rep_rows WHERE variable IN ('A', 'R') GROUP BY 1, 2),
less AS (SELECT geoid, r, ae, ar, greatest(re - 5000 * (s_suppkey % 2), 0) AS re,
         greatest(rr - 5000 * (s_suppkey % 2), 0) AS rr
         FROM wide JOIN supplier ON s_suppkey::varchar = geoid),
vals AS (SELECT geoid, r, CASE WHEN re = 0 THEN 0 ELSE ae / re END AS est,
                CASE WHEN rr = 0 THEN 0 ELSE ar / rr END AS v FROM less)"""


def _thinned(spark, sf):
    """Denominators lowered by 5000 in every second area, not below zero."""
    lower = 5000.0 * (F.col("geoid").cast("long") % 2)
    thin = F.col("variable") == "R"
    cut = lambda c: F.greatest(c - lower, F.lit(0.0))
    df = replicate_cells(spark, sf)
    return df.withColumns(
        {
            "est": F.when(thin, cut(F.col("est"))).otherwise(F.col("est")),
            "reps": F.when(thin, F.transform("reps", cut)).otherwise(F.col("reps")),
        }
    )


@query(
    "replicate_function",
    f"""WITH {RATIO_SQL} SELECT geoid, round(est, 6) AS est,
    CASE WHEN est = 0 THEN NULL ELSE
      round(1.645 * sqrt(4.0e0/80 * sum((v - est) * (v - est))), 6) END AS moe
    FROM vals GROUP BY geoid, est""",
)
def _(spark, sf):
    func = lambda v: divide(v["A"], v["R"])
    return rounded(mr.estimate(_thinned(spark, sf), ["A", "R"], func))


@query("replicate_function_pandas", ORACLE["replicate_function"])
def _(spark, sf):
    func = lambda ests, up: up * ests["A"] / ests["R"]
    return rounded(mr.estimate_pandas(_thinned(spark, sf), ["A", "R"], func, up=1.0))


INDEX_SQL = f"""{REPLICATE_ROWS_SQL},
versions AS (SELECT geoid, variable, 0 AS r, est AS v FROM rep_rows WHERE r = 1
  UNION ALL SELECT geoid, variable, r, rep FROM rep_rows),
w AS (SELECT geoid, r, max(CASE WHEN variable = 'A' THEN v END) AS a, max(CASE WHEN variable = 'R' THEN v END) AS b,
        (geoid::int % 4)::varchar AS part FROM versions GROUP BY 1, 2)"""


def _index_sql(keys):
    on = " AND ".join(f"w.{k} = t.{k}" for k in (*keys, "r"))
    by = "".join(f"{k}, " for k in keys)
    of = "".join(f"w.{k}, " for k in keys)
    return f"""WITH {INDEX_SQL}, t AS (SELECT {by}r, sum(a) AS sa, sum(b) AS sb FROM w GROUP BY {by}r),
    i AS (SELECT {of}w.r, 0.5 * sum(abs(a / sa - b / sb)) AS d FROM w JOIN t ON {on} GROUP BY {of}w.r),
    e AS (SELECT * FROM i WHERE r = 0)
    SELECT {"".join(f"i.{k}, " for k in keys)}round(e.d, 9) AS est, round(1.645 * sqrt(4.0e0/80 * sum((i.d - e.d) * (i.d - e.d))), 9) AS moe
    FROM i JOIN e ON {" AND ".join([f"i.{k} = e.{k}" for k in keys] + ["i.r > 0"])} GROUP BY {"".join(f"i.{k}, " for k in keys)}e.d"""


@query("dissimilarity_moe", _index_sql([]))
def _(spark, sf):
    return rounded(dissimilarity_with_moe(replicate_cells(spark, sf), "A", "R"), 9)


@query("dissimilarity_moe_by_part", _index_sql(["part"]))
def _(spark, sf):
    part = (F.col("geoid").cast("int") % 4).cast("string")
    return rounded(dissimilarity_with_moe(replicate_cells(spark, sf), "A", "R", {"part": part}), 9)


WEIGHTS_SQL = """
weights AS (SELECT n_nationkey AS k, n_nationkey::varchar AS fips, 5.0e0 + n_nationkey % 12 AS avg_weight FROM nation),
base AS (SELECT c_nationkey AS k, sum(abs(c_acctbal)) AS base FROM customer GROUP BY 1)"""


def _control(spark, sf):
    """Population, state code and average weight for each supplier's area."""
    supplier = table(spark, sf, "supplier")
    per = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.sum(F.abs("c_acctbal")).alias("base")
    )
    geoid = F.col("s_suppkey").cast("string").alias("geoid")
    base = supplier.join(per, supplier.s_nationkey == per.c_nationkey, "left").select(geoid, "base")
    state = supplier.select(geoid, text("s_nationkey", 2).alias("fips"))
    weights = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("fips"),
        (5.0 + F.col("n_nationkey") % 12).alias("avg_weight"),
    )
    return base, state, weights


BAND_SQL = """CASE WHEN base <= 4999 THEN 4 WHEN base <= 9999 THEN 8 WHEN base <= 19999 THEN 10
  WHEN base <= 29999 THEN 14 WHEN base <= 49999 THEN 18 WHEN base IS NOT NULL THEN 22 END"""


@query(
    "replicate_zero_counts",
    f"""WITH {REPLICATE_ROWS_SQL}, {WEIGHTS_SQL}, one AS (
      SELECT geoid, r, max(CASE WHEN variable = 'R' THEN greatest(est - 5000 * (geoid::bigint % 2), 0) END) AS est,
        max(CASE WHEN variable = 'R' THEN greatest(rep - 5000 * (geoid::bigint % 2), 0) END) AS v
      FROM rep_rows WHERE variable = 'R' GROUP BY 1, 2),
    m AS (SELECT geoid, est, 1.645 * sqrt(4.0e0/80 * sum((v - est) * (v - est))) AS moe,
                 min(v) = max(v) AS steady FROM one GROUP BY geoid, est)
    SELECT geoid, round(est, 6) AS est, round(CASE WHEN est = 0 OR steady THEN
       1.645 * sqrt(avg_weight * {BAND_SQL}) ELSE moe END, 6) AS moe
    FROM m JOIN supplier ON s_suppkey::varchar = geoid
    LEFT JOIN base ON base.k = s_nationkey LEFT JOIN weights ON weights.k = s_nationkey""",
)
def _(spark, sf):
    base, state, weights = _control(spark, sf)
    out = mr.estimate(
        _thinned(spark, sf), ["R"], lambda v: v["R"], "count", True, base, state, weights
    )
    return rounded(out)


@query(
    "replicate_zero_shares",
    f"""WITH {RATIO_SQL}, {WEIGHTS_SQL}, clipped AS (
      SELECT geoid, least(est, 1) AS est, least(v, 1) AS v FROM vals),
    m AS (SELECT geoid, est, 1.645 * sqrt(4.0e0/80 * sum((v - est) * (v - est))) AS moe
          FROM clipped GROUP BY geoid, est),
    w AS (SELECT geoid, est, moe, avg_weight / base AS share
      FROM m JOIN supplier ON s_suppkey::varchar = geoid
      LEFT JOIN base ON base.k = s_nationkey LEFT JOIN weights ON weights.k = s_nationkey)
    SELECT geoid, round(est, 6) AS est, round(CASE WHEN est IN (0, 1) THEN
       1.645 * sqrt(least(2.3 * share, 0.5) * (1 - least(2.3 * share, 0.5)) * share)
       ELSE moe END, 8) AS moe FROM w""",
)
def _(spark, sf):
    base, state, weights = _control(spark, sf)

    def clipped(v):
        share = divide(v["A"], v["R"])
        infinite = share == F.lit(float("inf"))
        return F.when(infinite, F.lit(0.0)).otherwise(F.least(share, F.lit(1.0)))

    out = mr.estimate(
        _thinned(spark, sf), ["A", "R"], clipped, "prop", True, base, state, weights
    )
    return rounded(rounded(out, 6, "est"), 8, "moe")


@query(
    "replicate_insert_constant",
    f"""WITH {REPLICATE_ROWS_SQL}, areas AS (SELECT DISTINCT geoid FROM rep_rows),
    allrows AS (SELECT geoid, variable, r, est, rep FROM rep_rows
      UNION ALL SELECT geoid, 'K', r, s_acctbal, s_acctbal
      FROM areas JOIN supplier ON s_suppkey::varchar = geoid, range(1, 81) AS t(r))
    SELECT geoid, variable, round(est, 6) AS est,
      round(1.645 * sqrt(4.0e0/80 * sum((rep - est) * (rep - est))), 4) AS moe,
      round(sum(rep), 4) AS rep_sum FROM allrows GROUP BY geoid, variable, est""",
)
def _(spark, sf):
    value = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("geoid"), F.col("s_acctbal").alias("value")
    )
    df = mr.insert_constant(replicate_cells(spark, sf), value, "K")
    total = F.aggregate("reps", F.lit(0.0), lambda acc, r: acc + r).alias("rep_sum")
    out = df.select("geoid", "variable", "est", "moe", total)
    return rounded(rounded(out, 6, "est"), 4, "moe", "rep_sum")


@query(
    "replicate_tables_side_by_side",
    f"""WITH {REPLICATE_ROWS_SQL}, e AS (SELECT DISTINCT geoid, variable, est FROM rep_rows),
    a AS (SELECT geoid, est AS "A" FROM e WHERE variable = 'A'),
    n AS (SELECT geoid, est AS "N" FROM e WHERE variable = 'N' AND est > 5000)
    SELECT coalesce(a.geoid, n.geoid) AS geoid, "A", "N" FROM a FULL JOIN n ON a.geoid = n.geoid""",
)
def _(spark, sf):
    df = replicate_cells(spark, sf)
    left = mr.wide_table(df.where(F.col("variable") == "A"), ["A"])
    right = df.where("variable = 'N' AND est > 5000")
    return mr.side_by_side([left, mr.wide_table(right, ["N"])])


@query(
    "population_of_areas",
    """WITH people AS (SELECT '0400000US' || lpad(c_nationkey::varchar, 2, '0') AS s,
        '0500000US' || lpad(c_nationkey::varchar, 2, '0') || substr(c_mktsegment, 1, 3) AS c, c_mktsegment AS seg FROM customer),
    areas AS (SELECT s AS geoid FROM people UNION SELECT c FROM people),
    st AS (SELECT s AS geoid, count(*) AS p FROM people GROUP BY 1),
    ct AS (SELECT c AS geoid, count(*) AS p FROM people WHERE seg <> 'BUILDING' GROUP BY 1)
    SELECT geoid, substr(split_part(geoid, 'US', 2), 1, 2) AS state,
           CASE WHEN geoid LIKE '04%' THEN st.p ELSE ct.p END::double AS base
    FROM areas LEFT JOIN st USING (geoid) LEFT JOIN ct USING (geoid)""",
)
def _(spark, sf):
    people = table(spark, sf, "customer").select(
        F.concat(F.lit("0400000US"), text("c_nationkey", 2)).alias("state"),
        F.concat(
            F.lit("0500000US"), text("c_nationkey", 2), F.substring("c_mktsegment", 1, 3)
        ).alias("county"),
        "c_mktsegment",
    )
    count = F.count("*").alias("population")
    areas = people.select(F.col("state").alias("geoid")).unionByName(
        people.select(F.col("county").alias("geoid"))
    ).distinct()
    counted = people.where("c_mktsegment <> 'BUILDING'")
    populations = {
        "state": people.groupBy(F.col("state").alias("geoid")).agg(count),
        "county": counted.groupBy(F.col("county").alias("geoid")).agg(count),
    }
    out = mr.population_of(areas, populations)
    return out.select("geoid", ids.state_of("geoid").alias("state"), "base")


# --- simulation ------------------------------------------------------------------------------

def _draws_sql(key, sims=100, rep_style=True):
    """Simulated cells in SQL: one row per area, variable and simulation."""
    return f"""{CELLS_SQL}, digests AS (
      SELECT geoid, variable, est, moe, sim, md5({key}) AS h FROM cells, range(0, {sims}) AS t(sim)),
    u AS (SELECT *, ('0x' || substr(h, 1, 13))::bigint::double / 4503599627370496e0 AS u1,
                    ('0x' || substr(h, 14, 13))::bigint::double / 4503599627370496e0 AS u2 FROM digests),
    z AS (SELECT *, est + moe / 1.645 * {0.5 if rep_style else 1.0}
                    * sqrt(-2 * ln(1 - u1)) * cos(2 * pi() * u2) AS raw FROM u)"""


OWN_KEY = "'7|' || geoid || '|' || variable || '|' || sim::varchar"
SHARED_KEY = "'7|' || sim::varchar"


@query(
    "simulated_moe",
    f"""WITH {_draws_sql(OWN_KEY)},
    s AS (SELECT *, CASE WHEN est = 0 THEN 0 WHEN moe = 0 THEN est ELSE raw END AS cell FROM z),
    f AS (SELECT geoid, sim, sum(est) AS est, sum(cell) AS v FROM s GROUP BY 1, 2)
    SELECT geoid, round(est, 6) AS est,
      round(1.6448536269514722 * sqrt(4.0e0/100 * sum((v - est) * (v - est))), 6) AS moe
    FROM f GROUP BY geoid, est""",
)
def _(spark, sf):
    func = lambda v: v["A"] + v["N"] + v["R"]
    return rounded(ms.simulate(cells(spark, sf), ["A", "N", "R"], func, seed=7))


@query("simulated_moe_pandas", ORACLE["simulated_moe"])
def _(spark, sf):
    func = lambda ests: ests.sum(axis=1)
    return rounded(ms.simulate_pandas(cells(spark, sf), ["A", "N", "R"], func, seed=7))


@query(
    "simulated_interval",
    f"""WITH {_draws_sql(SHARED_KEY, 60, False)},
    s AS (SELECT *, CASE WHEN moe = 0 THEN est ELSE raw END AS c1 FROM z),
    c AS (SELECT *, round_even(greatest(c1, 0), 0) AS cell FROM s),
    f AS (SELECT geoid, sim, max(CASE WHEN variable = 'A' THEN est END) + max(CASE WHEN variable = 'R' THEN est END) AS est,
          max(CASE WHEN variable = 'A' THEN cell END) + max(CASE WHEN variable = 'R' THEN cell END) AS v
          FROM c GROUP BY 1, 2),
    o AS (SELECT geoid, est, list_sort(list(v)) AS vs FROM f GROUP BY geoid, est)
    SELECT geoid, round(est, 6) AS est,
      round((vs[ceil(0.95 * 59)::int + 1] - vs[floor(0.05 * 59)::int + 1]) / 2, 6) AS moe FROM o""",
)
def _(spark, sf):
    out = ms.simulate(
        cells(spark, sf),
        ["A", "R"],
        lambda v: v["A"] + v["R"],
        sims=60,
        ignore_zeros="no",
        truncate=True,
        whole=True,
        analytic=False,
        rep_style=False,
        single_draw=True,
        seed=7,
    )
    return rounded(out)


PARTIAL_SQL = f"""{_draws_sql(OWN_KEY, 50, False)},
    base AS (SELECT s_suppkey::varchar AS geoid, CASE WHEN s_acctbal < 1000 THEN 0 ELSE s_acctbal END AS base FROM supplier),
    s AS (SELECT z.*, CASE WHEN base = 0 THEN 0 WHEN moe = 0 THEN est ELSE raw END AS cell
          FROM z LEFT JOIN base USING (geoid)),
    f AS (SELECT geoid, sim, max(CASE WHEN variable = 'A' THEN est END) AS ae, max(CASE WHEN variable = 'N' THEN est END) AS ne,
          max(CASE WHEN variable = 'A' THEN cell END) AS av, max(CASE WHEN variable = 'N' THEN cell END) AS nv
          FROM s GROUP BY 1, 2),
    q AS (SELECT geoid, sim, ae / nullif(ne, 0) AS est, coalesce(av / nullif(nv, 0), 0) AS v FROM f)"""


def _partial(spark, sf, **options):
    balance = F.col("s_acctbal")
    base = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("geoid"),
        F.when(balance < 1000, F.lit(0.0)).otherwise(balance).alias("base"),
    )
    return ms.simulate(
        cells(spark, sf),
        ["A", "N"],
        lambda v: divide(v["A"], v["N"]),
        sims=50,
        ignore_zeros="partial",
        base=base,
        rep_style=False,
        replace_na=0,
        seed=7,
        **options,
    )


@query(
    "simulated_moe_empty_areas",
    f"""WITH {PARTIAL_SQL} SELECT geoid, round(est, 6) AS est,
    round(1.6448536269514722 * stddev_pop(v), 4) AS moe FROM q GROUP BY geoid, est""",
)
def _(spark, sf):
    return rounded(rounded(_partial(spark, sf), 6, "est"), 4, "moe")


@query(
    "simulated_moe_pooled",
    f"""WITH {PARTIAL_SQL} SELECT DISTINCT geoid, round(est, 6) AS est,
    round((SELECT 1.6448536269514722 * stddev_pop(v) FROM q), 4) AS moe FROM q""",
)
def _(spark, sf):
    return rounded(rounded(_partial(spark, sf, pooled=True), 6, "est"), 4, "moe")
