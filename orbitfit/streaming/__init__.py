"""Structured Streaming entry points.

The analytics this library rebuilds are batch fits; there is no stream,
watermark or state operator to reproduce. What does carry over is scoring:
the assignment of points to fitted centres (K10) is a stateless projection,
so it runs unchanged on a streaming DataFrame.
"""

from orbitfit.streaming.assign import assign_stream

__all__ = ["assign_stream"]
