"""Column functions: text, dates, geometry and time."""
