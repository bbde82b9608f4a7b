"""Structured Streaming: the batch scoring job applied to arriving files."""

from tabml.streaming.scoring import score_stream

__all__ = ["score_stream"]
