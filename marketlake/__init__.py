"""Market-data lake maintenance and analytics on PySpark DataFrames."""
