"""Column-level helpers: pure functions from columns and literals to columns."""
