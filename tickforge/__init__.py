"""Market-data features, bars and enrichment as Spark DataFrame operators."""
