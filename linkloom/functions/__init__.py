"""functions of linkloom."""
