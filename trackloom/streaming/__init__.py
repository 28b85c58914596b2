"""Structured Streaming jobs made of the same operators."""

from trackloom.streaming.jobs import (
    epoch_files,
    feed_raw,
    smooth_stream,
    topic_messages,
    typed_stream,
)
from trackloom.streaming.ledger import Ledger
from trackloom.streaming.recovering import (
    counting_step,
    device_step,
    lone_fixes,
    retry_waiting,
    retrying_step,
    start,
)

__all__ = [
    "Ledger",
    "counting_step",
    "device_step",
    "epoch_files",
    "feed_raw",
    "lone_fixes",
    "retry_waiting",
    "retrying_step",
    "smooth_stream",
    "start",
    "topic_messages",
    "typed_stream",
]
