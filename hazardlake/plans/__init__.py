"""Composed batch plans and view frames."""
