"""Structured Streaming entry points.

The analytics themselves are batch (the reference has no streams, windows or
state). The one incremental piece is the append load of landing files,
re-expressed as an exactly-once file stream in ``landing``.
"""
