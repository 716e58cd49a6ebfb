"""Social-event analytics on Spark: DataFrame-to-DataFrame operators."""
