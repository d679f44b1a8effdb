"""Catalogue and review analytics as DataFrame-to-DataFrame functions on Spark."""
