"""Orchestration (month runs, back-fill) and the registered query catalogue."""
