"""Streams of observations."""
