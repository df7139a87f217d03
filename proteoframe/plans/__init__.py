"""Domain projections of the driver tables and the registered queries."""
