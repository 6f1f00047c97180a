"""Road-traffic analytics on Spark: tables and streams of vehicle observations."""
