"""Cleaning rules and checks, as functions from DataFrame to DataFrame."""
