"""DataFrame-to-DataFrame text operators."""
