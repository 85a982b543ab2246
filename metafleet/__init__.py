"""Compare many near-identical databases: snapshots, identity, merges, history, drift and rules on Spark."""
