"""Moving, checking and summarising tabular, nested and event data with Spark."""
