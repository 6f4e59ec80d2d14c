"""Structured Streaming form of the batch landing (see ``batches``)."""

from .batches import land_region, stream_establishments

__all__ = ["land_region", "stream_establishments"]
