"""Table-to-table operators: DataFrames in, DataFrames (or a write) out."""
