"""Sinks: durable snapshots and plain text."""

from baton.sinks.lifecycle import Lease, hold_application, lease_snapshot, sweep_snapshots
from baton.sinks.snapshot import release_snapshot, write_snapshot
from baton.sinks.text import save_text

__all__ = ["Lease", "hold_application", "lease_snapshot", "release_snapshot", "save_text", "sweep_snapshots", "write_snapshot"]
