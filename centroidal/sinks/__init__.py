"""Writers: assignments, result rows, run records, centroid and experiment records, history."""
