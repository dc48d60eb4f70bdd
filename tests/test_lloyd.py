
import numpy as np
import pytest
from pyspark.sql import functions as F

from centroidal.operators.assign import assign_nearest
from centroidal.operators.lloyd import fit_kmeans
from centroidal.operators.prepare import clean_points, fold_duplicates, zone_lookup
from centroidal.plans import catalog
from centroidal.sources import fixtures as FX

from conftest import SF0001

X, Y = "pickup_longitude", "pickup_latitude"


@pytest.fixture(scope="module")
def pts(spark):
    return catalog.points(spark, SF0001).cache()


@pytest.fixture(scope="module")
def model(pts):
    return fit_kmeans(pts, 4, 30, key="id", init="kmeans++")


def brute_force_lloyd(xs, ys, centres, iters):
    """Plain NumPy Lloyd with the same rules: first strict minimum, micro-unit means, empty keeps."""
    cx = np.array([c[0] for c in centres])
    cy = np.array([c[1] for c in centres])
    ux = np.floor(xs * 1e6 + 0.5).astype(np.int64)
    uy = np.floor(ys * 1e6 + 0.5).astype(np.int64)
    for _ in range(iters):
        d = (xs[:, None] - cx[None, :]) * (xs[:, None] - cx[None, :]) + \
            (ys[:, None] - cy[None, :]) * (ys[:, None] - cy[None, :])
        k = d.argmin(axis=1)
        for j in range(len(cx)):
            sel = k == j
            n = int(sel.sum())
            if n:
                cx[j] = float(int(ux[sel].sum())) / float(n) / 1e6
                cy[j] = float(int(uy[sel].sum())) / float(n) / 1e6
    return list(zip(cx.tolist(), cy.tolist()))


def test_matches_brute_force(pts, model):
    rows = pts.select(X, Y).collect()
    xs = np.array([r[0] for r in rows])
    ys = np.array([r[1] for r in rows])
    expected = brute_force_lloyd(xs, ys, model.seeds, model.iterations)
    assert model.centres == expected


def test_counts_sum_to_n_and_converges(pts, model):
    assert sum(model.counts) == pts.count() == model.n_points
    assert model.converged and model.history[-1]["n_moved"] == 0


def test_wcss_after_never_above_before(model):
    for h in model.history:
        assert h["wcss_after"] <= h["wcss"] * (1 + 1e-9) + 1e-9
    # Lloyd never increases the objective between iterations.
    w = [h["wcss"] for h in model.history]
    assert all(b <= a * (1 + 1e-9) for a, b in zip(w, w[1:]))


def test_every_point_assigned_to_nearest(pts, model):
    a = assign_nearest(pts, model.centres, dist_col="d").collect()
    c = np.array(model.centres)
    for r in a[:300]:
        d = (r[X] - c[:, 0]) ** 2 + (r[Y] - c[:, 1]) ** 2
        assert r["cluster_id"] == int(np.argmin(d))


def test_refit_from_converged_moves_nothing(pts, model):
    m2 = fit_kmeans(pts, 4, 5, key="id", initial_centres=model.centres)
    # Iteration 0 counts every point as moved (V7); iteration 1 finds nothing to move.
    assert m2.iterations == 2 and m2.history[0]["n_moved"] == pts.count() and m2.history[1]["n_moved"] == 0
    assert m2.centres == model.centres


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_partition_independent(pts, model, parts):
    m = fit_kmeans(pts.repartition(parts), 4, 30, key="id", init="kmeans++")
    assert m.centres == model.centres and m.counts == model.counts and m.seeds == model.seeds


@pytest.mark.parametrize("method", ["arrow", "expr"])
def test_methods_agree(pts, model, method):
    m = fit_kmeans(pts, 4, 30, key="id", initial_centres=model.seeds, method=method)
    assert m.centres == model.centres and m.counts == model.counts


def test_seed_permutation_permutes_ids(pts, model):
    perm = [2, 0, 3, 1]
    m = fit_kmeans(pts, 4, 30, key="id", initial_centres=[model.seeds[i] for i in perm])
    assert m.centres == [model.centres[i] for i in perm]


def test_folded_equals_unfolded(spark):
    trips = clean_points(zone_lookup(FX.fx_trips(spark, SF0001), FX.fx_zones(spark)), "longitude", "latitude")
    start = FX.FX_CENTRES
    plain = fit_kmeans(trips, len(start), 10, initial_centres=start)
    folded = fit_kmeans(fold_duplicates(trips), len(start), 10, initial_centres=start, weight="weight")
    assert plain.centres == folded.centres and plain.counts == folded.counts
    assert plain.history[-1]["n_moved"] == folded.history[-1]["n_moved"]


def test_keyless_sampled_seeding_on_duplicates(spark):
    trips = clean_points(zone_lookup(FX.fx_trips(spark, SF0001), FX.fx_zones(spark)), "longitude", "latitude")
    m = fit_kmeans(trips, 8, 10, init="sample", sample_target=50)
    assert len(set(m.seeds)) == 8 and sum(m.counts) == trips.count()


def test_same_order_of_wcss_as_mllib(spark, pts, model):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=[X, Y], outputCol="features").transform(pts)
    ml = KMeans(k=4, seed=42, maxIter=30).fit(v)
    ml_wcss = ml.summary.trainingCost
    assert 0.5 < model.final_wcss / ml_wcss < 2.0


def test_no_rows_reach_driver_in_iteration_plan(pts):
    from centroidal.operators.lloyd import lloyd_aggregate
    plan = lloyd_aggregate(pts, [(-74.5, 40.5), (-73.5, 41.0)], [(-74.0, 40.0), (-73.0, 41.0)])._jdf \
        .queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan or "MapInPandas" in plan
    assert "HashAggregate" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan


def test_hash_sample_is_partition_independent(pts):
    from centroidal.operators.seed import hash_sample
    a = sorted(r["id"] for r in hash_sample(pts, 200, "id").collect())
    b = sorted(r["id"] for r in hash_sample(pts.repartition(5), 200, "id").collect())
    assert a == b and 100 < len(a) < 300


def test_weighted_draw_follows_weights(spark):
    from centroidal.operators.seed import weighted_draw
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 7.0), (3, 0.0)], "id bigint, w double")
    counts = [0, 0, 0, 0]
    for s in range(300):
        counts[weighted_draw(df, "w", "id", seed=s).first()["id"]] += 1
    assert counts[3] == 0
    assert counts[2] > counts[1] > counts[0] > 5


def test_seeding_without_a_key_draws_locations(spark):
    # Three locations, one of them repeated often: all three are drawn, as distinct centres.
    rows = [(-74.0, 40.0)] * 50 + [(-73.5, 40.5)] * 3 + [(-73.2, 41.0)]
    df = spark.createDataFrame(rows, f"{X} double, {Y} double")
    for init in ("kmeans++", "sample"):
        m = fit_kmeans(df, 3, 20, init=init)
        assert sorted(m.seeds) == sorted(set(rows)) and sorted(m.counts) == [1, 3, 50] and m.converged


def test_seeding_plan_reads_a_cached_fold(spark):
    from centroidal.operators import lloyd as L
    seen = []
    real = L.kmeanspp

    def spy(df, *args):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args)
    L.kmeanspp = spy
    try:
        fit_kmeans(spark.createDataFrame([(-74.0, 40.0), (-73.0, 41.0)] * 4, f"{X} double, {Y} double"), 2, 5, init="kmeans++")
    finally:
        L.kmeanspp = real
    assert "InMemoryTableScan" in seen[0]


def test_large_weights_sum_exactly(spark):
    rows = [(-74.0, 40.0, 2 * 10 ** 11), (-74.000003, 40.1, 2 * 10 ** 11 + 7), (-73.9, 41.25, 3)]
    df = spark.createDataFrame(rows, f"{X} double, {Y} double, weight bigint")
    units = [(round(a * 10 ** 6), round(b * 10 ** 6), w) for a, b, w in rows]
    want = (sum(a * w for a, _, w in units), sum(b * w for _, b, w in units), sum(w for _, _, w in units))
    from centroidal.operators.lloyd import lloyd_aggregate
    for method in ("partials", "arrow", "expr"):
        [r] = lloyd_aggregate(df, [(-74.0, 40.5)], weight="weight", method=method).collect()
        assert (int(r["sx"]), int(r["sy"]), r["n"]) == want, method
    with pytest.raises(Exception, match="negative"):
        lloyd_aggregate(df.selectExpr(X, Y, "-weight AS weight"), [(-74.0, 40.5)], weight="weight").collect()


def test_assignment_of_null_coordinates_is_null(spark):
    df = spark.createDataFrame([(0, None, 40.5), (1, -74.0, 40.5)], "id bigint, pickup_longitude double, "
                                                                      "pickup_latitude double")
    for method in ("arrow", "expr"):
        got = {r["id"]: r["cluster_id"] for r in assign_nearest(df, [(-74.0, 40.0)], method=method).collect()}
        assert got == {0: None, 1: 0}


def test_checkpoint_storage_gives_the_same_fit(pts, model):
    m = fit_kmeans(pts, 4, 30, key="id", initial_centres=model.seeds, storage="checkpoint")
    assert m.centres == model.centres and m.counts == model.counts


def test_sampled_seeding_of_keyed_weighted_rows(spark):
    # Folded rows with their own key: the sample fraction must come from the row count, not the
    # total weight (46 rows carrying about 2,400 points at sf0.001).
    trips = clean_points(zone_lookup(FX.fx_trips(spark, SF0001), FX.fx_zones(spark)), "longitude", "latitude")
    folded = fold_duplicates(trips).withColumn("loc", F.concat_ws(",", X, Y))
    m = fit_kmeans(folded, 8, 10, key="loc", weight="weight", init="sample", sample_target=100)
    assert len(set(m.seeds)) == 8 and sum(m.counts) == trips.count()
