"""Table operators: DataFrames in, one DataFrame out, no action inside unless the docstring says so."""
