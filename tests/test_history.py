
import os

import pytest

from centroidal.operators import history as H
from centroidal.sources.history import read_run_history

# The 20 run records of the reference's metrics file, in file order. GPU rows carry
# eleven fields (h2d, kmeans, d2h, elapsed, wcss, throughput) under the eight-field header.
RECORDED = """impl,K,threads,n_points,iterations,elapsed_ms,wcss,throughput_pts_sec
serial,8,1,36830903,3,1400.56,1.3130e+03,78891691
openmp,8,4,36830903,3,723.87,1.3130e+03,152641503
serial,8,1,36830903,3,1675.63,1.3130e+03,65941035
openmp,8,1,36830903,3,1330.63,1.3130e+03,83037696
openmp,8,2,36830903,3,771.26,1.3130e+03,143262226
openmp,8,4,36830903,3,709.38,1.3130e+03,155758606
openmp,8,8,36830903,3,527.51,1.3130e+03,209461833
openmp,8,16,36830903,3,407.76,1.3130e+03,270974867
cuda,8,GPU,585694,5,3.13,19.55,0.63,23.31,3.1645e+01,149781973
cuda,8,GPU,702860,10,2.57,34.16,0.74,37.47,2.6686e+01,205756994
cuda,8,GPU,3866226,5,14.44,128.89,3.45,146.78,1.3592e+02,149979926
serial,8,1,1000000,3,53.08,4.0813e+01,56519461
cuda,8,GPU,1000000,10,4.07,39.42,0.94,44.44,4.0813e+01,253674641
openmp,8,1,500000,3,22.05,2.0360e+01,68037720
openmp,8,2,1000000,3,27.67,4.0813e+01,108428106
openmp,8,4,2000000,2,27.44,6.8253e+01,145747981
openmp,8,8,4000000,3,66.50,1.6014e+02,180453160
openmp,8,16,8000000,3,89.90,7.7035e+02,266967789
serial,8,1,36830903,3,1597.31,1.3130e+03,69174338
openmp,8,4,36830903,3,735.58,1.3130e+03,150211466
"""


@pytest.fixture(scope="module")
def runs(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="centroidal-hist-")
    with open(os.path.join(d, "runs.csv"), "w") as f:
        f.write(RECORDED)
    return read_run_history(spark, d).cache()


def test_ragged_rows_are_typed_by_layout(runs):
    assert runs.count() == 20
    gpu = runs.filter("impl = 'cuda'").orderBy("run_id").first()
    assert (gpu["h2d_ms"], gpu["kmeans_ms"], gpu["d2h_ms"], gpu["elapsed_ms"]) == (3.13, 19.55, 0.63, 23.31)
    assert gpu["wcss"] == 31.645 and gpu["throughput_pts_sec"] == 149781973.0
    cpu = runs.filter("impl = 'serial'").orderBy("run_id").first()
    assert cpu["h2d_ms"] is None and cpu["elapsed_ms"] == 1400.56 and cpu["wcss"] == 1313.0


def test_baseline_is_first_of_greatest_n(runs):
    b = H.baseline_run(runs).first()
    assert (b["base_n"], b["base_ms"], b["base_iterations"]) == (36830903, 1400.56, 3)


def test_strong_scaling_golden(runs):
    rows = {r["threads"]: r for r in H.strong_scaling(runs).collect()}
    assert rows["1 (serial)"]["speedup"] == 1.0 and rows["1 (serial)"]["efficiency"] == 100.0
    expected = {"1": (1330.63, 1.053, 105.3), "2": (771.26, 1.816, 90.8), "4": (722.94, 1.937, 48.4),
                "8": (527.51, 2.655, 33.2), "16": (407.76, 3.435, 21.5)}
    for t, (ms, sp, eff) in expected.items():
        assert round(rows[t]["mean_ms"], 2) == ms
        assert round(rows[t]["speedup"], 3) == sp
        assert round(rows[t]["efficiency"], 1) == eff
    assert round(rows["16"]["throughput"]) == round(36830903 * 3 / 0.40776)


def test_amdahl_golden(runs):
    a = H.amdahl(H.strong_scaling(runs)).first()
    assert round(a["parallel_fraction"] * 100, 1) == 75.6
    assert round(a["limit"], 1) == 4.1


def test_weak_scaling_golden(runs):
    rows = H.weak_scaling(runs).collect()
    eff = {r["n_points"]: round(r["efficiency"], 1) for r in rows if r["n_points"] < 36830903}
    assert eff == {500000: 100.0, 1000000: 79.7, 2000000: 80.4, 4000000: 33.2, 8000000: 24.5}
    assert len(rows) == 12  # every openmp run, strong-scaling sets included, as in the reference


def test_weak_scaling_proportional_option(runs):
    rows = H.weak_scaling(runs, proportional_only=True, points_per_thread=500000).collect()
    assert sorted(r["n_points"] for r in rows) == [500000, 1000000, 2000000, 4000000, 8000000]


def test_impl_speedup_at_equal_n(runs):
    rows = {(r["impl"], r["n_points"]): r for r in H.impl_speedup(runs).collect()}
    assert round(rows[("cuda", 1000000)]["speedup"], 2) == 1.19
    assert round(rows[("openmp", 36830903)]["speedup"], 3) == round(
        (1400.56 + 1675.63 + 1597.31) / 3 / ((723.87 + 1330.63 + 771.26 + 709.38 + 527.51 + 407.76 + 735.58) / 7), 3)


def test_best_throughput_and_summary(runs):
    best = {r["impl"]: r for r in H.best_throughput(runs).collect()}
    assert best["openmp"]["best_throughput"] == 270974867.0
    assert best["cuda"]["best_throughput"] == 253674641.0
    assert best["openmp"]["min_single_thread_ms"] == 22.05
    s = H.run_summary(runs).first()
    assert s["n_runs"] == 20 and s["n_impls"] == 3


def test_chart_table_has_no_n_filter(runs):
    rows = {r["threads"]: r for r in H.strong_scaling(runs, same_n=False).collect()}
    assert round(rows["1"]["mean_ms"], 2) == round((1330.63 + 22.05) / 2, 2)


def test_recorded_throughput_is_consistent(runs):
    for r in H.recomputed_throughput(runs).filter("impl <> 'cuda'").collect():
        assert abs(r["throughput_check"] / r["throughput_pts_sec"] - 1) < 2e-4


def test_strong_scaling_needs_both_kinds_of_runs(runs):
    assert H.strong_scaling(runs.filter("impl <> 'serial'")).count() == 0
    assert H.strong_scaling(runs.filter("impl <> 'openmp'")).count() == 0
    assert H.amdahl(H.strong_scaling(runs.filter("impl <> 'serial'"))).count() == 0


def test_analyze_command_report(spark, runs, tmpdir_run):
    import io
    from centroidal.plans.analyze import analyze
    buf = io.StringIO()
    analyze(spark, runs, f"{tmpdir_run}/tables", out=buf)
    text = buf.getvalue()
    assert "Runs: 20" in text and "cuda, openmp, serial" in text
    assert "1.94x" in text and "48.4%" in text and "75.6%" in text and "4.1x" in text
    assert spark.read.option("header", True).csv(f"{tmpdir_run}/tables/weak_scaling").count() == 12


def test_analyze_main_on_parquet_runs(spark, runs, tmpdir_run, capsys):
    from centroidal.plans.analyze import main
    runs.write.parquet(f"{tmpdir_run}/runs")
    assert main([f"{tmpdir_run}/runs", "--format", "parquet"]) == 0
    out = capsys.readouterr().out
    assert "STRONG SCALING" in out and "Threads" in out and "3.43x" in out


def test_run_ids_follow_the_files_and_lines(spark, tmpdir_run):
    from centroidal.sources.history import HEADER, read_run_history
    row = "serial,8,1,{n},3,{ms},1.0e+00,1"
    # The second file is longer; splits are packed by size, ids must still follow names and lines.
    for name, times in (("a.csv", [111]), ("b.csv", range(222, 262))):
        with open(f"{tmpdir_run}/{name}", "w") as f:
            f.write("\n".join([HEADER, *(row.format(n=100, ms=ms) for ms in times)]) + "\n")
    got = [r["elapsed_ms"] for r in read_run_history(spark, tmpdir_run).orderBy("run_id").collect()]
    assert got == [111.0, *map(float, range(222, 262))]
    assert H.baseline_run(read_run_history(spark, tmpdir_run)).first()["base_ms"] == 111.0
    listed = read_run_history(spark, [f"{tmpdir_run}/b.csv", f"{tmpdir_run}/a.csv"])
    assert H.baseline_run(listed).first()["base_ms"] == 222.0


def test_zero_times_and_odd_threads(spark, runs):
    odd = spark.createDataFrame([(90, "openmp", 8, "0", 36830903, 3, None, None, None, 0.0, 1.0, 1.0),
                                 (91, "openmp", 8, "many", 36830903, 3, None, None, None, 5.0, 1.0, 1.0)], runs.schema)
    every = runs.unionByName(odd)
    weak = {r["run_id"]: r["efficiency"] for r in H.weak_scaling(every).collect()}
    assert weak[90] is None and weak[91] is not None
    strong = {r["threads"]: r for r in H.strong_scaling(every).collect()}
    assert strong["0"]["efficiency"] is None and strong["0"]["throughput"] is None and strong["many"]["efficiency"] == 0
    assert "many" not in {r["threads"] for r in H.strong_scaling(every, same_n=False).collect()}


def test_serial_row_stands_without_runs_at_its_size(runs):
    rows = H.strong_scaling(runs.filter("impl = 'serial' or n_points < 36830903")).collect()
    assert [r["threads"] for r in rows] == ["1 (serial)"]


def test_job_records_feed_the_analysis(spark, tmpdir_run):
    from centroidal.operators.lloyd import fit_kmeans
    from centroidal.sinks.writers import append_run_records, run_record
    df = spark.createDataFrame([(-74.0 + i / 100, 40.0 + i / 50) for i in range(20)], "pickup_longitude double, pickup_latitude double")
    model = fit_kmeans(df, 2, 20, initial_centres=[(-74.0, 40.0), (-73.8, 40.4)])
    for impl, threads in (("serial", "1"), ("spark", "4"), ("spark", "8")):
        append_run_records(run_record(spark, model, impl, threads), f"{tmpdir_run}/runs")
    recorded = spark.read.parquet(f"{tmpdir_run}/runs")
    assert recorded.filter("run_id is null").count() == 0 and recorded.select("run_id").distinct().count() == 3
    table = H.strong_scaling(recorded, "serial", "spark").orderBy("row_order").collect()
    assert [r["threads"] for r in table] == ["1 (serial)", "4", "8"]
