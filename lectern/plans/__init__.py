"""User-visible queries assembled from the operators."""
