"""Next-word prediction models from trigram counts, as plain Spark DataFrame code."""
