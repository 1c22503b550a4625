"""Reading and writing: day-partitioned tables, flux files, manual flags and metadata."""
