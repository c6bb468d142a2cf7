"""operators of linkloom."""
