"""Plans: which methods run on a dataset, in which order."""
