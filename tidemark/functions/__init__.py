"""Column building helpers: rounding, time buckets and text lines."""
