"""Column-level functions: they take and return ``Column`` objects and never trigger a job."""
