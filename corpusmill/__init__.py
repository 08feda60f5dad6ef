"""corpusmill: corpus building on Spark, one DataFrame-to-DataFrame operator at a time."""
