"""Spark-native lakehouse operators for claim records: bronze, silver and gold."""
