"""Readers and writers. Every schema is declared, nothing is inferred."""
