from feedlens.sources.events import (
    FEED_SCHEMA,
    MESSAGE_SCHEMA,
    feed_actions,
    message_actions,
    read_events,
    read_feed_actions,
    read_message_actions,
)
from feedlens.sources.sink import METRICS_CUBE_SCHEMA, write_metrics_cube, read_metrics_cube

__all__ = [
    "FEED_SCHEMA",
    "MESSAGE_SCHEMA",
    "METRICS_CUBE_SCHEMA",
    "feed_actions",
    "message_actions",
    "read_events",
    "read_feed_actions",
    "read_message_actions",
    "write_metrics_cube",
    "read_metrics_cube",
]
