"""Reading and writing: CSV, text lines and Kafka topics."""

from trackloom.sources.file_topic import register_file_topic
from trackloom.sources.readers import (
    one_of_each,
    read_keyed_lines,
    read_lines_stream,
    read_raw_csv,
    read_raw_csv_stream,
    read_stream,
    read_topic_bounded,
    starting_offsets,
)
from trackloom.sources.writers import (
    keyed_lines,
    raw_messages,
    smoothed_messages,
    write_csv,
    write_keyed_lines,
    write_topic,
)

__all__ = [
    "keyed_lines",
    "one_of_each",
    "raw_messages",
    "read_keyed_lines",
    "read_lines_stream",
    "read_raw_csv",
    "read_raw_csv_stream",
    "read_stream",
    "read_topic_bounded",
    "register_file_topic",
    "smoothed_messages",
    "starting_offsets",
    "write_csv",
    "write_keyed_lines",
    "write_topic",
]
