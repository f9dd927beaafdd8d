"""Relational and model-fitting operators; each takes and returns DataFrames."""
