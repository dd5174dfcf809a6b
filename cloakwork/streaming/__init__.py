"""Masking of unbounded inputs."""
