"""Spark-native analytics for tandem repeats and genomic intervals."""
