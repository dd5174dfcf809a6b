"""Scalar functions."""
