"""Processing data as it arrives."""
