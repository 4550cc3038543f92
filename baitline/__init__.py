"""Target-capture analytics on Spark: DataFrame-to-DataFrame operators keyed by sample and gene."""
