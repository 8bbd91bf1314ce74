"""Blockloom: segmentation, scoring and classification of integer-addressed entities on Spark."""
