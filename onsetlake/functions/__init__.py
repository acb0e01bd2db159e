"""Column-level helpers and the small per-group kernels used inside Spark tasks."""
