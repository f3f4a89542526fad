"""Market-state analytics on Spark."""
