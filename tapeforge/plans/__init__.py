"""plans of the securities master."""
