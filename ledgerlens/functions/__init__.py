"""ledgerlens.functions."""
