"""Session, campaign and search-interest analytics as Spark DataFrame plans."""
