"""Change-log analytics on PySpark: decode, rebuild state, query, tier, stream."""
