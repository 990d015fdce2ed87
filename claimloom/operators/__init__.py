"""DataFrame-to-DataFrame operators for every layer."""
