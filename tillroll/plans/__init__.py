"""Composite queries: each is ``(spark, base) -> DataFrame`` over the given
tables, built from the operators."""
