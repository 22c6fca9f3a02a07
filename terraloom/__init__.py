"""Rasters, patch embeddings and point clouds as Spark tables."""
