"""Feedback analytics on PySpark: text preparation, deduplication, funnel,
clustering, scoring and published queries, expressed as DataFrame plans."""
