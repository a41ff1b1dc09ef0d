"""Whole preparation plans built from the operators."""
