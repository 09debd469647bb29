"""unifeed: Spark-native engine that unifies event logs from many hands into one
typed event feed -- scans, canonical mapping, repair expressions, union,
contamination filter, gap-fill anti-join, blocked fuzzy reconciliation,
one-pass quality scoring, summaries and a presentation table."""

__version__ = "0.1.0"
