"""Scans (A1-A9), the trip-shaped landing data, and table sinks."""
