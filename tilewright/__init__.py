"""Spatial coverage analytics on Spark: normalized features, a grid of cells, and metrics per cell and source group."""
