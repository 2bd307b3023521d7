"""Streaming adapters.

The batch jobs are the engine. A stream of documents is handled one
micro-batch at a time (``foreachBatch``): merges run against a static base,
and incremental frames run one round per batch over a durable state folder.
"""

from .increments import start_increment_stream
from .merges import start_merge_stream

__all__ = ["start_increment_stream", "start_merge_stream"]
