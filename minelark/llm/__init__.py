"""Operators and stages for preparing training text."""
