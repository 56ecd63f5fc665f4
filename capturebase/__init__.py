"""Versioned captures of notice archives as DataFrame and SQL surfaces."""
