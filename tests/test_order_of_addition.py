"""Results that must not depend on the order in which rows are added, and SQL that must hold at any size."""

from itertools import permutations

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bureauflow.functions import ranking
from bureauflow.operators import calibration, metrics
from bureauflow.operators.families import family_frame
from bureauflow.schema import KEY
from oracles.model import CHI2_TAIL, bin_of, edges


def people(small, field, values):
    """Applicants and tradelines: an applicant for every order of the values of one field."""
    apps, bureau = small
    orders = sorted(set(permutations(values)))
    some = F.array(*[F.array(*map(F.lit, x)) for x in orders])
    lines = bureau.where("product_type = 'MORTGAGE'").limit(1).select("*", F.posexplode(some).alias("who", "all"))
    lines = lines.withColumn("customer_id", F.concat(F.lit("C"), "who")).select("*", F.posexplode("all").alias("at", "it"))
    lines = lines.withColumns({"application_id": F.col("customer_id"), "tradeline_id": F.col("at"), field: F.col("it")})
    row = apps.limit(1).withColumn("application_date", F.lit("2000-01-01").cast("date"))
    row = row.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("who"))
    row = row.withColumns({"customer_id": F.concat(F.lit("C"), "who"), "application_id": F.concat(F.lit("C"), "who")})
    return row.select(apps.columns), lines.select(bureau.columns), len(orders)


def test_spread_of_durations_at_half_the_mean(small):
    """Mean 60 and deviation 30 exactly: not above one half in any order."""
    apps, lines, n = people(small, "duration_months", [43, 37, 39, 106, 75])
    lines = lines.withColumn("opening_date", F.lit("1999-01-01").cast("date"))
    got = family_frame(apps, lines, ["duration_risk"]).select(*KEY, "mixed_duration_portfolio", "duration_cv").collect()
    assert len(got) == n and {r["mixed_duration_portfolio"] for r in got} == {0}
    apps, lines, n = people(small, "duration_months", [43, 37, 39, 107, 75])
    lines = lines.withColumn("opening_date", F.lit("1999-01-01").cast("date"))
    got = family_frame(apps, lines, ["duration_risk"]).collect()
    assert len(got) == n and {r["mixed_duration_portfolio"] for r in got} == {1}


def test_mean_age_is_the_same_in_any_order(small):
    days = [F.date_sub(F.lit("2000-01-01").cast("date"), k) for k in (13, 101, 977, 1501, 2222)]
    apps, lines, n = people(small, "duration_months", [0, 1, 2, 3, 4])
    lines = lines.withColumn("opening_date", F.array(*days)[F.col("duration_months")])
    got = family_frame(apps, lines, ["temporal"]).collect()
    assert len(got) == n and {r["avg_credit_age_months"] for r in got} == {(13 + 101 + 977 + 1501 + 2222) / 5 / 30.44}


@pytest.mark.parametrize("chi2", [0.5, 7.3, 40.0, 900.0, 1e6, 5e6])
@pytest.mark.parametrize("dof", [1, 7, 8])
def test_tail_in_sql(chi2, dof):
    got = duckdb.connect().execute(f"SELECT {CHI2_TAIL} FROM (SELECT {chi2}::DOUBLE AS chi2, {dof} AS dof)").fetchone()[0]
    assert abs(got - calibration.chi2_tail(chi2, dof)) < 1e-7


def test_edges_that_are_values(spark):
    """(n - 1) * 0.7 is just below a whole number for these n: the row of the edge stays in the lower bin, in the query and in the SQL."""
    sizes = [n for n in range(600, 3600, 10) if (n) * 0.7 != 7 * (n // 10)][:40]
    rows = [(n, k, round(340000 + 7919 * k % 100003 * 1.37, 2)) for n in sizes for k in range(n + 1)]
    table = pa.Table.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["g", "k", "value"])
    df = spark.createDataFrame(table).withColumn("target", (F.col("k") % 3 == 0).cast("int"))
    got = {r["g"]: r["q"] for r in ranking.quantiles(df, ["g"], "value", [0.0, 0.7, 1.0]).collect()}
    values = {n: sorted(v for g, _, v in rows if g == n) for n in sizes}
    assert len(sizes) == 40 and got == {n: [v[0], v[7 * n // 10], v[-1]] for n, v in values.items()}
    lift = {(r["g"], r["decile"]): r["n"] for r in metrics.lift_table(df, "value", "target", ["g"]).collect()}
    con = duckdb.connect()
    con.register("src", table)
    sql = f"WITH {edges('e', 'src', 'g')} SELECT g, CAST(max(len(edges)) - 1 - {bin_of('value')} AS INTEGER), count(*) FROM src JOIN e USING (g) GROUP BY g, {bin_of('value')}"
    assert lift == {(g, d): n for g, d, n in con.execute(sql).fetchall()}
