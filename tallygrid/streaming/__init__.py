"""Streaming forms of the daily, session and anomaly reports."""
