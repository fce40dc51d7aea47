"""Density of genes that arrive as a stream."""
