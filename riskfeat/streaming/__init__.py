"""Streaming entry points.

The reference is a batch job with no stream operators (no watermark, no
stream window, no state), so none is added here. What streams naturally is
the row-level preparation: ``stream_log`` applies the same time-part parsing
to a log arriving as files, and ``append_to_table`` lands each micro-batch in
a Parquet table that the batch feature job reads.
"""

from .logs import append_to_table, stream_log  # noqa: F401
