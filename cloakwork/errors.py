"""Errors and the exit codes of the command line."""

from __future__ import annotations


class CloakError(Exception):
    """Base: internal failure. Messages never hold values of the data."""

    exit_code = 6


class PolicyError(CloakError):
    exit_code = 2


class GenerationError(CloakError):
    exit_code = 3


class TransformError(CloakError):
    exit_code = 4


class VerificationError(CloakError):
    exit_code = 5


class RegistryError(CloakError):
    exit_code = 6


class RegistryConflict(RegistryError):
    """A mapping would break uniqueness, or a key is already assigned."""
