"""Scalar building blocks that stay inside generated code."""
