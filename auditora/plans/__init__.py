"""Plans of the audit engine."""
