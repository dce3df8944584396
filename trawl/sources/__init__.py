"""Class tables, rule files and change feeds read as DataFrames."""
