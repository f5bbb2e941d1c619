"""DataFrame-to-DataFrame operators, one per business rule."""
