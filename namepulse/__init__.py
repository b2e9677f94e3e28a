"""Name histograms over packed news records, written as Spark jobs."""
