"""Batch operators."""
