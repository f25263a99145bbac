"""Order documents from JSON files to a curated order table, on Spark."""
