"""Reading snapshots and storing tables."""
