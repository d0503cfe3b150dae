"""Training-data preparation as Spark DataFrame operators."""
