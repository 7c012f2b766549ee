"""Scalar building blocks; each returns a Column and stays inside code generation."""
