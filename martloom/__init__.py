"""Finance and marketing analytics for e-commerce data, as PySpark jobs."""
