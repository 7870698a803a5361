"""Table operators: DataFrames in, lazy DataFrame out."""
