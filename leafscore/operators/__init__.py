"""Operators on DataFrames: cleaning, alignment, ranks, folds, metrics, text, vectors, models."""
