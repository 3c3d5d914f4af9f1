"""Fits and whole flows built from the operators."""
