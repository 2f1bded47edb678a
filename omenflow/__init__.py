"""Text-assessment analytics on Spark: scans, features, matching, labels, metrics, agreement."""
