"""Batch and stream sources: the event topic, JSON messages, cost uploads."""
