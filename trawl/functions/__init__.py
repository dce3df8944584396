"""Column-to-Column text analysis and value conversion."""
