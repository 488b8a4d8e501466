"""biblioscope: literature-graph analytics as Spark DataFrame jobs."""
