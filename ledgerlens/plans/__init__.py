"""ledgerlens.plans."""
