"""Operators for preparing training text: each module holds one, with its own interface."""
