"""Reading input files, writing output files, versioned tables and ingestion."""
