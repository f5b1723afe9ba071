"""Readers: files, message logs, change feeds, derived synthetic rows."""
