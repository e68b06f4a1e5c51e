"""Feed analytics on Spark: a DataFrame-first engine for news and document feeds."""
