"""Stand-in inputs built from the test tables (FIXTURES.md part B), each in Spark and in DuckDB SQL.

These only shape rows of the test tables into the schemas the operators expect; they do none of the
operators' work. The SQL form of each fixture is the same expression, so the oracle statements read
exactly the rows the Spark queries read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centroidal.sources.history import HEADER

X, Y = "pickup_longitude", "pickup_latitude"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# --- FX1 points: coordinates in and around the box, unique key (from orders) -----------------------

def fx_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.lit(-75.25) + F.col("o_totalprice") / F.lit(200000.0)).alias(X),
        (F.lit(39.75) + F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")) / F.lit(1200.0)).alias(Y),
    )


FX_POINTS_SQL = (
    "SELECT o_orderkey AS id, "
    "-75.25::DOUBLE + o_totalprice / 200000.0::DOUBLE AS pickup_longitude, "
    "39.75::DOUBLE + date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) / 1200.0::DOUBLE AS pickup_latitude "
    "FROM orders"
)


# --- FX2 zones: a 60-row dimension with gaps in its keys ---------------------------------------------

def fx_zones(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(60).select(
        (i * 2 + 1).cast("int").alias("LocationID"),
        (F.lit(-75.25) + (i % 9).cast("double") * F.lit(0.25)).alias("longitude"),
        (F.lit(39.75) + (i % 8).cast("double") * F.lit(0.25)).alias("latitude"),
    )


FX_ZONES_SQL = (
    "SELECT CAST(2 * i + 1 AS INTEGER) AS LocationID, "
    "-75.25::DOUBLE + (i % 9)::DOUBLE * 0.25::DOUBLE AS longitude, "
    "39.75::DOUBLE + (i % 8)::DOUBLE * 0.25::DOUBLE AS latitude "
    "FROM (SELECT range AS i FROM range(60))"
)


# --- FX3 trips: the fact table of the zone lookup (from lineitem) ------------------------------------

def fx_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_partkey") % 120).cast("int").alias("LocationID"),
        F.month("l_shipdate").alias("file_tag"),
    )


FX_TRIPS_SQL = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CAST(l_partkey % 120 AS INTEGER) AS LocationID, CAST(month(l_shipdate) AS INTEGER) AS file_tag "
    "FROM lineitem"
)


# --- FX5 raw lines: malformed point text (from orders) ----------------------------------------------

def fx_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    r = F.col("o_orderkey") % 10
    n = F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    lat = F.concat(F.lit("40."), n)
    line = (F.when(r == 0, F.lit("0,0,0"))
            .when(r == 1, F.concat(F.lit("0,0,0,0,0,abc,"), lat))
            .when(r == 2, F.concat(F.lit("0,0,0,0,0,,"), lat))
            .when(r == 3, F.concat(F.lit("0,0,0,0,0,-76."), n, F.lit(","), lat))
            .when(r == 4, F.concat(F.lit("0,0,0,0,0,nan,"), lat))
            .otherwise(F.concat(F.lit("0,0,0,0,0,-74."), n, F.lit(","), lat)))
    return o.select(F.col("o_orderkey").alias("id"), line.alias("line"))


FX_RAW_LINES_SQL = (
    "SELECT o_orderkey AS id, CASE o_orderkey % 10 "
    "WHEN 0 THEN '0,0,0' "
    "WHEN 1 THEN '0,0,0,0,0,abc,40.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') "
    "WHEN 2 THEN '0,0,0,0,0,,40.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') "
    "WHEN 3 THEN '0,0,0,0,0,-76.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || ',40.' "
    "|| lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') "
    "WHEN 4 THEN '0,0,0,0,0,nan,40.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') "
    "ELSE '0,0,0,0,0,-74.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || ',40.' "
    "|| lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END AS line FROM orders"
)


# --- FX7 centres: fixed centres for single-step queries ---------------------------------------------

# Centre 4 is far from every point and must stay in place with count 0.
FX_CENTRES = [(-74.5, 40.5), (-74.5, 41.0), (-73.5, 40.5), (-73.5, 41.0), (-60.0, 10.0)]


# --- Run history stand-in (schema of FIXTURES FX4, rows from orders) --------------------------------
# impl from the order status, threads from the priority digit (1, 2, 4, 8, 16), N from the customer,
# times and quality from the price. GPU rows carry the three transfer timings.

def fx_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    impl = (F.when(F.col("o_orderstatus") == "F", F.lit("serial"))
            .when(F.col("o_orderstatus") == "O", F.lit("openmp")).otherwise(F.lit("cuda")))
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    threads = (F.when(impl == "serial", F.lit("1"))
               .when(impl == "openmp", F.pow(F.lit(2), digit - 1).cast("int").cast("string"))
               .otherwise(F.lit("GPU")))
    n_points = ((F.col("o_custkey") % 4) + 1) * 1000000
    iterations = (F.col("o_custkey") % 3 + 2).cast("int")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    elapsed = cents.cast("double") / F.lit(10000.0)
    gpu = impl == "cuda"
    return o.select(
        F.col("o_orderkey").alias("run_id"), impl.alias("impl"), F.lit(8).alias("K"),
        threads.alias("threads"), n_points.cast("bigint").alias("n_points"), iterations.alias("iterations"),
        F.when(gpu, elapsed / 8).alias("h2d_ms"), F.when(gpu, elapsed * 3 / 4).alias("kmeans_ms"),
        F.when(gpu, elapsed / 8).alias("d2h_ms"), elapsed.alias("elapsed_ms"),
        (F.col("o_custkey").cast("double") / F.lit(7.0)).alias("wcss"),
        (n_points.cast("double") * iterations / (elapsed / F.lit(1000.0))).alias("throughput_pts_sec"),
    )


FX_RUNS_SQL = """
SELECT o_orderkey AS run_id, impl, 8 AS K,
  CASE impl WHEN 'serial' THEN '1' WHEN 'openmp' THEN CAST(1 << (digit - 1) AS VARCHAR) ELSE 'GPU' END AS threads,
  CAST(((o_custkey % 4) + 1) * 1000000 AS BIGINT) AS n_points,
  CAST(o_custkey % 3 + 2 AS INTEGER) AS iterations,
  CASE WHEN impl = 'cuda' THEN elapsed / 8 END AS h2d_ms,
  CASE WHEN impl = 'cuda' THEN elapsed * 3 / 4 END AS kmeans_ms,
  CASE WHEN impl = 'cuda' THEN elapsed / 8 END AS d2h_ms,
  elapsed AS elapsed_ms,
  o_custkey::DOUBLE / 7.0::DOUBLE AS wcss,
  CAST(((o_custkey % 4) + 1) * 1000000 AS BIGINT)::DOUBLE * CAST(o_custkey % 3 + 2 AS INTEGER)
    / (elapsed / 1000.0::DOUBLE) AS throughput_pts_sec
FROM (SELECT *,
        CASE o_orderstatus WHEN 'F' THEN 'serial' WHEN 'O' THEN 'openmp' ELSE 'cuda' END AS impl,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS digit,
        CAST(round(o_totalprice * 100) AS BIGINT)::DOUBLE / 10000.0::DOUBLE AS elapsed
      FROM orders)
"""


def fx_run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records as ragged text lines (8 or 11 fields), with a header line, from orders.

    Numbers are written from integers so the text is identical in any engine.
    """
    o = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")

    def money(c):
        return F.concat((c.cast("bigint") / 100).cast("bigint").cast("string"), F.lit("."),
                        F.lpad((c.cast("bigint") % 100).cast("string"), 2, "0"))

    mant = F.col("o_custkey") % 90000 + 10000
    sci = F.concat((mant / 10000).cast("bigint").cast("string"), F.lit("."),
                   F.lpad((mant % 10000).cast("string"), 4, "0"), F.lit("e+0"),
                   (F.col("o_orderkey") % 4).cast("string"))
    head = F.concat_ws(",", F.when(F.col("o_orderstatus") == "P", F.lit("cuda"))
                       .when(F.col("o_orderstatus") == "F", F.lit("serial")).otherwise(F.lit("openmp")),
                       F.lit("8"),
                       F.when(F.col("o_orderstatus") == "P", F.lit("GPU"))
                       .otherwise(F.substring("o_orderpriority", 1, 1)),
                       (((F.col("o_custkey") % 4) + 1) * 1000000).cast("string"),
                       (F.col("o_custkey") % 3 + 2).cast("string"))
    tput = (F.col("o_custkey") * 1000 + F.col("o_orderkey") % 1000).cast("string")
    gpu_mid = F.concat_ws(",", money(cents % 1000), money(cents), money(cents % 700))
    line = F.when(F.col("o_orderstatus") == "P",
                  F.concat_ws(",", head, gpu_mid, money(cents + 1500), sci, tput)) \
        .otherwise(F.concat_ws(",", head, money(cents), sci, tput))
    data = o.select((F.col("o_orderkey") + 2).alias("line_no"), line.alias("value"))
    header = spark.range(1).select(F.lit(1).cast("bigint").alias("line_no"),
                                   F.lit(HEADER)
                                   .alias("value"))
    return header.unionByName(data)


FX_RUN_LINES_SQL = """
SELECT 1::BIGINT AS line_no, '@HEADER@' AS value
UNION ALL
SELECT o_orderkey + 2 AS line_no,
  CASE WHEN o_orderstatus = 'P'
    THEN head || ',' || money_a || ',' || money_c || ',' || money_b || ',' || money_d || ',' || sci || ',' || tput
    ELSE head || ',' || money_c || ',' || sci || ',' || tput END AS value
FROM (
  SELECT o_orderkey, o_orderstatus,
    CASE o_orderstatus WHEN 'P' THEN 'cuda' WHEN 'F' THEN 'serial' ELSE 'openmp' END || ',8,' ||
      CASE WHEN o_orderstatus = 'P' THEN 'GPU' ELSE substr(o_orderpriority, 1, 1) END || ',' ||
      CAST(((o_custkey % 4) + 1) * 1000000 AS VARCHAR) || ',' || CAST(o_custkey % 3 + 2 AS VARCHAR) AS head,
    CAST((cents % 1000) // 100 AS VARCHAR) || '.' || lpad(CAST((cents % 1000) % 100 AS VARCHAR), 2, '0') AS money_a,
    CAST((cents % 700) // 100 AS VARCHAR) || '.' || lpad(CAST((cents % 700) % 100 AS VARCHAR), 2, '0') AS money_b,
    CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS money_c,
    CAST((cents + 1500) // 100 AS VARCHAR) || '.' || lpad(CAST((cents + 1500) % 100 AS VARCHAR), 2, '0') AS money_d,
    CAST((o_custkey % 90000 + 10000) // 10000 AS VARCHAR) || '.' ||
      lpad(CAST((o_custkey % 90000 + 10000) % 10000 AS VARCHAR), 4, '0') || 'e+0' || CAST(o_orderkey % 4 AS VARCHAR) AS sci,
    CAST(o_custkey * 1000 + o_orderkey % 1000 AS VARCHAR) AS tput
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
)
""".replace("@HEADER@", HEADER)


# --- Line points: continuous coordinates with a text key (from lineitem) ----------------------------
# lineitem is unique only on (l_orderkey, l_linenumber, l_partkey, l_suppkey), so the key is their text.

def fx_line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return li.select(
        key.alias("id"),
        (F.lit(-75.25) + F.col("l_extendedprice") / F.lit(50000.0)).alias(X),
        (F.lit(39.75) + F.datediff(F.col("l_shipdate"), F.lit("1995-01-01").cast("date")) / F.lit(1200.0)).alias(Y),
    )


FX_LINE_POINTS_SQL = (
    "SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || "
    "CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) AS id, "
    "-75.25::DOUBLE + l_extendedprice / 50000.0::DOUBLE AS pickup_longitude, "
    "39.75::DOUBLE + date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) / 1200.0::DOUBLE AS pickup_latitude "
    "FROM lineitem"
)
