"""Whole normalisation runs and audits."""
