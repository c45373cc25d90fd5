"""Securities master jobs on Spark: landed feeds to one canonical table."""
