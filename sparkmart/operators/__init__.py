"""DataFrame operators: DataFrames in, DataFrame out."""
