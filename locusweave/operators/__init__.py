"""Operators on annotations: interval union, windows, range join, density cube, queries and statistics over it."""
