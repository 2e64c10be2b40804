"""Report templates and the monthly run."""
