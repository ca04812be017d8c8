"""Operators for preparing training text; see README. Nothing else in the library imports this folder."""
