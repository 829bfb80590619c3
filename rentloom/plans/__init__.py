"""One module per listing site, and the two output tables."""
