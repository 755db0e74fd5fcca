"""laptrace: competition results to model-ready features, as plain Spark DataFrame operators."""
