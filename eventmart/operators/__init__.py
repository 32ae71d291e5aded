"""Row- and group-level operators on DataFrames."""
