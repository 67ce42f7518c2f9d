"""Readers of landed snapshot folders."""
