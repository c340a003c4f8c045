"""Data-governance operators for batch tables, written as Spark DataFrame transformations."""
