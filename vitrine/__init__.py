"""Vitrine: refine, profile, rank and forecast classified listings on Spark."""

__version__ = "0.1.0"
