"""Scalar functions: native Column expressions where Spark has the means, Arrow batches where it has not."""
