"""Landing files, layer tables and event files."""
