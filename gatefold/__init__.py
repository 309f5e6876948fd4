"""gatefold: customer, event and revenue analytics as PySpark DataFrame functions."""
