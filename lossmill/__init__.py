"""Insurance portfolio analytics written as Spark DataFrame and pyspark.ml jobs."""
