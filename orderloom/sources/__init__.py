"""Where data comes from and where tables live."""
