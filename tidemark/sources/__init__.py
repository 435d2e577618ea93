"""Reading landed data, the shared work folder, and writing tables."""
