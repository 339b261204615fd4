"""Contract-usage analytics on Spark: what customers bought, what they use, and what the rest is worth."""
