"""Table operators: every one takes data frames and returns a data frame."""
