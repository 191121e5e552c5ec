"""Readers of input files and the stored tables."""
