"""centroidal: K-Means clustering and run analysis of point data, written on the PySpark DataFrame API.

Layout
------
sources/    readers: points (Parquet/CSV/positional CSV/text lines), zone tables, run history
functions/  Column expressions: distances, nearest centre, hash uniforms, scaling metrics, formatting
operators/  DataFrame operators: preparation, assignment, seeding, Lloyd iteration, evaluation, history
sinks/      writers: assignments, result rows, centroid/experiment records, run records
plans/      the spark-submit job and the catalogue of registered queries with their SQL oracles
streaming/  the prediction operator applied to a Structured Streaming source
"""

from centroidal.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
