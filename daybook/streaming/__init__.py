"""Keeping published datasets current: incremental day refresh and sync log."""

from daybook.streaming.clocks import Clock  # noqa: F401
from daybook.streaming.live import follow, stored_runs  # noqa: F401
from daybook.streaming.refresh import open_days, refresh_days  # noqa: F401
from daybook.streaming.state import State  # noqa: F401
from daybook.streaming.store import last_published_day, publish, read_published  # noqa: F401
from daybook.streaming.synclog import append_sync, sync_watermarks  # noqa: F401
