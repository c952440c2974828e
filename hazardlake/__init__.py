"""Spark operators for hazard event feeds and country indicator panels."""
