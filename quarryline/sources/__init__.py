"""Readers: text first, types by declaration."""
