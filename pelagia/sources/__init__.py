"""Readers of raw artifacts."""
