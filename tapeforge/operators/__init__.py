"""operators of the securities master."""
