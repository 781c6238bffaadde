"""Registered queries, by family."""

from . import channels, daily, files, marketing, rules, scalars, whole
from .base import REGISTRY

__all__ = ["REGISTRY", "channels", "daily", "files", "marketing", "rules", "scalars", "whole"]
