"""Layer definitions: clean, dimensions, facts, reporting, gates, measures."""
