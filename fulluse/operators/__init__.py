"""Models, audit, checks and analytical queries: DataFrames in, DataFrame out."""
