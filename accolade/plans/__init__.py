"""The recognition pipeline, assembled from the generic operators."""
