"""Operators for preparing training text at scale, and the queries that apply them."""

from .queries import REGISTRY

__all__ = ["REGISTRY"]
