"""Retail table operators for Spark: DataFrame in, DataFrame out."""
