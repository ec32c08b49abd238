"""Readers of the framed binary formats and Arrow IPC."""
