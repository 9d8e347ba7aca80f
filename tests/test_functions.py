import math

import duckdb
import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lossmill.functions import keyed
from lossmill.functions.losses import average_severity, poisson_deviance
from lossmill.functions.rounding import percent, ratio, round_away, settle
from lossmill.params import Calendar, Delay

TIES = [1.005, 2.675, -1.005, 0.125, -0.125, 2.5, -2.5, 0.005, 1e15 + 0.5, -0.0, 103.125]


def duck_round(values, digits):
    frame = pd.DataFrame({"i": range(len(values)), "x": values})  # noqa: F841
    sql = f"SELECT ROUND(x, {digits}) AS r FROM frame ORDER BY i"
    return duckdb.sql(sql).df()["r"].tolist()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e9, 1e9), min_size=20, max_size=60), st.sampled_from([2, 4]))
def test_round_away_is_the_scaled_rounding(spark, drawn, digits):
    values = drawn + TIES + [round(v, digits) + 5 / 10 ** (digits + 1) for v in drawn]
    frame = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    found = [r[0] for r in frame.orderBy("i").select(round_away(F.col("x"), digits)).collect()]
    assert found == duck_round(values, digits)


def test_ratios_are_zero_safe(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0), (None, 2.0)], "a double, b double")
    rows = frame.select(ratio(F.col("a"), F.col("b")), percent(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [(None, None), (1 / 3, 33.33), (None, None)]


def test_settle_hides_the_summation_order(spark):
    frame = spark.createDataFrame([(0.1 + 0.2,), (0.3,), (1.005,), (-0.0,)], "x double")
    found = [r[0] for r in frame.select(settle(F.col("x"), 2)).collect()]
    assert found == [0.3, 0.3, 1.01, 0.0]
    assert math.copysign(1, found[3]) == 1


def test_keyed_draws_do_not_depend_on_the_partitioning(spark):
    keys = spark.range(0, 4000)
    u = keyed.uniform(keyed.digest(F.col("id"), "s")).alias("u")
    one = keys.coalesce(1).select("id", u).orderBy("id").toPandas()
    many = keys.repartition(7).select("id", u).orderBy("id").toPandas()
    assert one.equals(many)
    assert 0 < one.u.min() < one.u.max() < 1
    assert abs(one.u.mean() - 0.5) < 0.02


def test_keyed_lognormal_has_the_right_law(spark):
    h = keyed.digest(F.col("id"), "d")
    first, second = keyed.normal_pair(keyed.uniform(h, 0), keyed.uniform(h, 1))
    law = Delay(1.5, 1.2)
    logs = (
        spark.range(0, 20000)
        .select(F.log(keyed.lognormal(first, law)).alias("x"), second.alias("y"))
        .toPandas()
    )
    assert abs(logs.x.mean() - 1.5) < 0.03 and abs(logs.x.std() - 1.2) < 0.03
    assert abs(logs.y.mean()) < 0.03 and abs(logs.y.std() - 1) < 0.03
    assert abs(np.corrcoef(logs.x, logs.y)[0, 1]) < 0.03


def test_keyed_dates_fill_the_calendar(spark):
    calendar = Calendar(days=10)
    days = spark.range(0, 500).select(keyed.keyed_date(F.col("id"), calendar).alias("d"))
    found = {r["d"] for r in days.distinct().collect()}
    assert len(found) == 10 and min(found) == calendar.first_day


def test_poisson_deviance_and_severity(spark):
    frame = spark.createDataFrame([(0, 0.5), (2, 0.5)], "y long, mu double")
    found = [r[0] for r in frame.select(poisson_deviance(F.col("y"), F.col("mu"))).collect()]
    assert np.allclose(found, [1.0, 2 * (2 * math.log(4) - 1.5)])
    rows = frame.select(average_severity(F.col("mu"), F.col("y"))).collect()
    assert [r[0] for r in rows] == [None, 0.25]
