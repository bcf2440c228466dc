"""Query engine for linked scholarly data on PySpark."""
