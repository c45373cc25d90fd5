"""sources of the securities master."""
