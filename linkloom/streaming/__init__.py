"""streaming of linkloom."""
