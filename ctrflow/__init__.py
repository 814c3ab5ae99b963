"""Click-through-rate data work on Spark: DataFrame in, DataFrame out."""
