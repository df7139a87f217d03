"""proteoframe: Spark DataFrame operators for protein variant libraries."""
