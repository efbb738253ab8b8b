"""Explaining scans, and the engine's registered queries."""
