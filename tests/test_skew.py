"""A hot key holding a third of all rows: zone join (broadcast and shuffle fallback), folding, fitting."""

from pyspark.sql import functions as F

from centroidal.operators.lloyd import fit_kmeans
from centroidal.operators.prepare import clean_points, fold_duplicates, zone_lookup
from centroidal.sources import fixtures as FX

from conftest import SF001


def skewed_trips(spark):
    """FX3 trips where every third line item goes to zone 1 (a third of all rows on one key)."""
    t = FX.fx_trips(spark, SF001)
    return t.withColumn("LocationID", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("LocationID")))


def test_hot_zone_join_paths_agree(spark):
    # AQE splits a skewed partition along map-task boundaries; spread the single test file over
    # several partitions as a multi-file input would be.
    trips, zones = skewed_trips(spark).repartition(8), FX.fx_zones(spark)
    hot = trips.filter("LocationID = 1").count()
    assert hot * 3 >= trips.count() * 0.9
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "longitude", "latitude"]
    broadcast = zone_lookup(trips, zones).select(*cols)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        shuffled = zone_lookup(trips, zones).select(*cols)
        rows = shuffled.collect()
        final = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in final
        assert "skew=true" in final, final[:2000]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, broadcast.collect()))


def test_hot_location_folds_and_fits(spark):
    pts = clean_points(zone_lookup(skewed_trips(spark), FX.fx_zones(spark)), "longitude", "latitude")
    folded = fold_duplicates(pts)
    assert folded.agg(F.sum("weight")).first()[0] == pts.count()
    start = FX.FX_CENTRES
    plain = fit_kmeans(pts, len(start), 10, initial_centres=start)
    weighted = fit_kmeans(folded, len(start), 10, initial_centres=start, weight="weight")
    assert plain.centres == weighted.centres and plain.counts == weighted.counts
