"""sources of linkloom."""
