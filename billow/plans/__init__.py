"""Composed stages of the bronze -> silver -> gold run."""
