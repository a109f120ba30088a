"""DataFrame-to-DataFrame operators; all work on batch and, where noted, on streams."""
