"""Dimension runs built from the operators."""
