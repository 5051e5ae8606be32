"""Feature tables, pyspark.ml training jobs, batch scoring and model files."""
