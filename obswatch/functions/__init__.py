"""Column functions: calendars, text, JSON."""
