"""Streaming input.

The analyses are batch analyses and none keeps state across time.  What a
stream adds is the arrival of new ``::`` files; the same line parser applies
to a streaming text source unchanged.
"""

from rateweave.streaming.delimited_stream import read_delimited_stream

__all__ = ["read_delimited_stream"]
