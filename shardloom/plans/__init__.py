"""Plan-level helpers: derived test frames, registered queries, plan checks."""
