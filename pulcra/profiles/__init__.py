"""Ready-made profiles."""
