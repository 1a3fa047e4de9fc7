"""Operators for preparing training text. Nothing outside this subpackage depends on it."""
