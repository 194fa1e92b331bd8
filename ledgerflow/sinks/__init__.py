"""Sinks: files, tables, messages, and one-pass writes of two-output results."""
