"""Queries registered over the driver tables, each beside its SQL counterpart."""
