"""Review analytics on PySpark: sources, text, statistics, sampling, topics and summaries."""
