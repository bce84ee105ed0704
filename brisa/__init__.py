"""brisa: air-quality and weather analytics as PySpark DataFrame operators."""
