"""Road-traffic analytics as plain PySpark DataFrame functions."""
