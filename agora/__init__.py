"""Social-influence analytics on PySpark DataFrames."""
