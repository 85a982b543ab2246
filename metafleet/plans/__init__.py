"""Dataset registry, views and the registered queries."""
