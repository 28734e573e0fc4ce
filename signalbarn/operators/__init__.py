"""DataFrame operators by signal."""
