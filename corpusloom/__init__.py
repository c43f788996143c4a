"""A Spark-first engine for building, annotating and auditing text corpora."""
