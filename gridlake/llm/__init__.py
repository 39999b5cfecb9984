"""Operators for preparing large text corpora (see the README's table of them)."""
