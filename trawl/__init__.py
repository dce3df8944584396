"""trawl: full-text indexing and search over related tables, as Spark DataFrame jobs."""
