"""Column functions built on pyspark.sql.functions."""
