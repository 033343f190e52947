"""Reading, writing and describing source files."""
