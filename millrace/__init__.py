"""Change-log mirrors and trip analytics as reusable Spark DataFrame operators."""
