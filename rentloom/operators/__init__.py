"""DataFrame-to-DataFrame operators shared by all sites."""
