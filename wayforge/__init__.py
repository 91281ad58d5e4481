"""Catalog curation on Spark: DataFrame in, DataFrame out."""
