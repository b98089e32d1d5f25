"""Entity canonicalisation on Spark: DataFrame in, DataFrame out."""
