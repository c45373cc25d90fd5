"""streaming of the securities master."""
