"""Operators for the texts of a training corpus. Nothing else in the library imports this package."""
