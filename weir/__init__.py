"""Event-data operators for PySpark: DataFrame in, DataFrame out, batch and streaming."""
