"""The shuffle-free sequence scans on streaming DataFrames."""
