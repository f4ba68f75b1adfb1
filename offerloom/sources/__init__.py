"""Readers and writers: the only place that touches storage."""
