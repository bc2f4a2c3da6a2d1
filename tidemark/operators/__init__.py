"""Batch and stream operators over DataFrames."""
