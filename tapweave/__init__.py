"""Tap-to-journey inference on Spark DataFrames."""

from tapweave.config import Settings

__all__ = ["Settings"]
