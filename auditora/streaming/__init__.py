"""Streaming of the audit engine."""
