"""Reading and writing: the Bronze change log and the published tables."""
