"""Sources and sinks: chat/user table adapters, fixture tables, snapshots."""

from rewardloom.sources.tables import read_chat, read_sources, read_table, read_users
from rewardloom.sources import fixtures

__all__ = ["read_chat", "read_users", "read_sources", "read_table", "fixtures"]
