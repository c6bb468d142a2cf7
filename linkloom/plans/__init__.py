"""plans of linkloom."""
