"""Payloads of sources, landed files, typed tables."""
