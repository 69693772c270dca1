"""Structured Streaming entry point for the landing folder."""
