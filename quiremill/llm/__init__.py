"""Training-data operators: ten distributed stages for very large text corpora."""
