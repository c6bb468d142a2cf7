"""linkloom: a Spark-first web-link index with large-table data operators."""
