"""millrace: a Spark-first engine for change-event tables."""
