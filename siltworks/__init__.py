"""siltworks: rule-driven ingestion and transformation on Spark."""
