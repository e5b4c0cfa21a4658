"""Streaming.

The reference processes one bounded CSV per run and has no streams, windows
or state. The one streaming job here is the landing step (S1) run over a
drop folder: each new CSV file is landed exactly once, tracked by a
Structured Streaming checkpoint, so a refresh re-reads only new files.
"""

from rosterlens.streaming.landing import land_csv_stream

__all__ = ["land_csv_stream"]
