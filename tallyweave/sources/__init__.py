"""Readers that return DataFrames with explicit schemas."""
