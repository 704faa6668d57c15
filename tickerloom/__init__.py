"""Market-feature, sentiment and corpus operators written as Spark jobs."""
