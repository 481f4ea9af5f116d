"""folioforge: Spark-native extraction, reconciliation and reporting over document corpora."""
