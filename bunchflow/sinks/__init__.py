"""Writers of the framed formats and of small results."""
