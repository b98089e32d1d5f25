"""How work is laid out on the cluster: shared storage, skew-proof joins, the step runner."""
