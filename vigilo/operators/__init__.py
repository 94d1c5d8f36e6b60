"""DataFrame operators of the early-warning workflow."""
