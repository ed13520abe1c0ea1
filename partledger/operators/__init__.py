"""Table-to-table operators over DataFrames."""
