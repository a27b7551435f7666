"""Metric streams: counter rates, bounded history, snapshots, file intake."""
