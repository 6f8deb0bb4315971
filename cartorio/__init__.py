"""Public-health registry engine on PySpark: ingest, harmonise, compare and aggregate with DataFrames."""
