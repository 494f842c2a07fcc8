"""Training-data operators for text corpora."""
