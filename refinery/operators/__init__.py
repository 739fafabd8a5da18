"""DataFrame operators: Silver extraction, Gold aggregation, merge, reconcile."""
