"""quillmill: literature analytics as Spark DataFrame, SQL and streaming jobs."""
