"""Spatial cell analytics on Spark."""
