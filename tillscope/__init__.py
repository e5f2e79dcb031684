"""Retail star-schema analytics as PySpark DataFrame functions."""

from tillscope.star import Star

__all__ = ["Star"]
