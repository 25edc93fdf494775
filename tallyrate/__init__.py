"""Success-rate analytics on Spark: attempts in, rate tables and rate models out."""
