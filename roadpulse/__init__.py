"""Road-traffic analytics on Spark: speeds, robust bounds, alerts and signs."""
