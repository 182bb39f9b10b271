"""tidemark: market-microstructure analytics as PySpark DataFrame operators."""
