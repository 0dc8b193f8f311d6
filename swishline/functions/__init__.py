"""Column expressions: every scalar rule of the pipeline, once, as Spark columns."""
