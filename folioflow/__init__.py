"""Document analytics on Spark: every stage is a DataFrame transformation keyed by document."""
