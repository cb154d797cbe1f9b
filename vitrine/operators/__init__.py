"""DataFrame-to-DataFrame steps, one module per subject."""
