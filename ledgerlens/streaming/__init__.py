"""ledgerlens.streaming."""
