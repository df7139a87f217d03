"""Column-level building blocks: fixed tables, string scans, biophysics."""
