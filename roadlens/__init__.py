"""Road-traffic analytics as DataFrame-in, DataFrame-out Spark operators."""
