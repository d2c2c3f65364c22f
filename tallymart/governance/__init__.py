"""Who sees what, and when a refresh goes live."""
