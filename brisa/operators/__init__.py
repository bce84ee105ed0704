"""Public operators: DataFrames in, lazy DataFrame out."""
