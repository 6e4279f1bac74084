"""Readers, sinks and versioned stores; all paths go through Spark, so any Hadoop file system works."""
