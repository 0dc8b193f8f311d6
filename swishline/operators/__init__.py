"""DataFrame -> DataFrame operators, usable on batches and on micro-batches."""
