"""Operators of the audit engine."""
