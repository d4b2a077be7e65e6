"""Column-level helpers: pure functions from columns/params to Column expressions."""
