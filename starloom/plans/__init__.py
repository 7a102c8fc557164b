"""Whole layers and the microbatch job, put together from the operators."""
