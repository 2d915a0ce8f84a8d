"""Registry curation and corpus preparation on Spark."""
