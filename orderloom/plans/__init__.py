"""Whole-table and whole-report plans."""
