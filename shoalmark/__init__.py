"""Species-occurrence and ocean-environment analytics as Spark DataFrame operators."""
