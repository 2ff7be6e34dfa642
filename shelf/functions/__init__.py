"""Scalar Column functions."""
