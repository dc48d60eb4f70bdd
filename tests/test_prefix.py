"""Running sums, draws by them, ordered rows (W1, T1), and sums of doubles that no order changes (A3)."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from centroidal.functions.hashing import exponential_key, exponential_value, hash_uniform, uniform_value
from centroidal.functions.numeric import exact_double_sum, exact_double_sum_sql
from centroidal.operators.evaluate import order_by_cluster, wcss, wcss_per_cluster
from centroidal.operators.prefix import first_reaching, ordered_ranges, running_draw, running_sum
from centroidal.plans import catalog

from conftest import SF0001


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_running_sum_equals_a_loop(spark, parts):
    rnd = random.Random(parts)
    rows = [(k, rnd.choice([0, 1, 5, -3, 2 ** 61, None]), "x") for k in rnd.sample(range(10_000), 400)]
    got = running_sum(spark.createDataFrame(rows, "id long, u long, _note string").repartition(parts), "u", ["id"]).collect()
    total, want = 0, {}
    for k, u, _ in sorted(rows):
        total += u or 0
        want[k] = total
    assert {r["id"]: int(r["running"]) for r in got} == want and got[0]["_note"] == "x"


def test_no_task_orders_all_rows(spark):
    df = spark.range(1000).withColumn("w", F.col("id") % 7)
    plan = running_sum(df, "w", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_first_reaching_edges(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, 0), (4, 2), (5, 0)], "id long, u long").repartition(3)
    ranges = ordered_ranges(df, "u", ["id"])
    assert ranges.total == 5
    found = {t: [(r["id"], int(r["running"])) for r in first_reaching(ranges, t).collect()] for t in range(1, 7)}
    assert found == {1: [(2, 3)], 2: [(2, 3)], 3: [(2, 3)], 4: [(4, 5)], 5: [(4, 5)], 6: []}
    assert running_draw(df.withColumn("u", F.lit(0.0)), "u", ["id"], 1).collect() == []
    assert running_draw(df.limit(0), "u", ["id"], 1).collect() == []


def test_draws_follow_the_weights(spark):
    df = spark.createDataFrame([(k, float(w)) for k, w in enumerate((1, 0, 6, 3))], "id long, w double")
    ranges = ordered_ranges(df, F.col("w").cast("long"), ["id"])
    drawn = Counter(first_reaching(ranges, int(uniform_value("", seed, "t") * ranges.total) + 1).first()["id"] for seed in range(60))
    assert set(drawn) == {0, 2, 3} and drawn[2] > drawn[3] > drawn[0]


def test_driver_and_task_uniforms_agree(spark):
    rows = spark.createDataFrame([("a", 2.0), ("", 0.5), ("é9", 0.0)], "k string, w double").select(
        "k", "w", hash_uniform("k", 7, "s").alias("u"), exponential_key("k", "w", 7, "s").alias("e")).collect()
    for r in rows:
        assert uniform_value(r["k"], 7, "s") == r["u"]
        e = exponential_value(r["k"], r["w"], 7, "s")
        assert e == r["e"] or math.isclose(e, r["e"], rel_tol=1e-15)


def test_rows_in_cluster_order(spark):
    rows = [(k, (k * 7) % 3) for k in range(50)]
    out = order_by_cluster(spark.createDataFrame(rows, "id long, cluster_id int").repartition(4), ["id"]).collect()
    assert [(r["cluster_id"], r["id"]) for r in sorted(out, key=lambda r: r["position"])] == sorted((c, k) for k, c in rows)


values = st.lists(st.floats(0, 1e12, allow_subnormal=False) | st.floats(0, 1e-9, allow_subnormal=False), min_size=1, max_size=40)


@settings(max_examples=25, deadline=None)
@given(values)
def test_exact_sums_are_the_sum(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = [df.repartition(n).agg(exact_double_sum("v").alias("s")).first()["s"] for n in (1, 3)]
    assert got[0] == got[1] and math.isclose(got[0], math.fsum(xs), rel_tol=3e-16, abs_tol=1e-30)
    con = duckdb.connect()
    con.register("t", df.toPandas())
    assert con.execute(f"SELECT {exact_double_sum_sql('v')} FROM t").fetchone()[0] == got[0]


@pytest.mark.parametrize("parts", [3, 7])
def test_wcss_has_equal_bits_for_any_partitioning(spark, parts):
    pts = catalog.points(spark, SF0001)
    one, many = pts.coalesce(1), pts.repartition(parts)
    assert wcss(one, catalog.CENTRES).collect() == wcss(many, catalog.CENTRES).collect()
    assert sorted(wcss_per_cluster(one, catalog.CENTRES).collect()) == sorted(wcss_per_cluster(many, catalog.CENTRES).collect())
    assert spark.range(3).select(F.lit(None).cast("double").alias("v")).agg(exact_double_sum("v").alias("s")).first()["s"] is None


def test_exact_sum_of_wide_magnitudes(spark):
    xs = [1e15, 1e-15] * 500 + [0.1] * 1000
    got = spark.createDataFrame([(x,) for x in xs], "v double").agg(exact_double_sum("v").alias("s")).first()["s"]
    assert got == math.fsum(xs) and got != float(np.cumsum(xs)[-1]) or math.isclose(got, math.fsum(xs), rel_tol=3e-16)
