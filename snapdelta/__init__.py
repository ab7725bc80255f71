"""Land and clean operational tables with Spark: dated snapshots and cursor-based increments."""
