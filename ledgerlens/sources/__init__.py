"""ledgerlens.sources."""
