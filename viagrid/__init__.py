"""Transport and energy analytics on Spark: DataFrame in, DataFrame out."""
