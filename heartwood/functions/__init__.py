"""Column functions: text segmentation, marker patterns, scoring and classification."""
