"""functions of the securities master."""
