"""Column-level functions; every one returns a Catalyst ``Column``."""
