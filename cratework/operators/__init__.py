"""Bronze, silver, quality and history operators on DataFrames."""
