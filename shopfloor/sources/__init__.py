"""Scans, sinks and catalog registration."""
