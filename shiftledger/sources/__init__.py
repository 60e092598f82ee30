"""Inputs: shift-log CSV files and named tables."""
