"""DataFrame-in, DataFrame-out operators; no session creation, no collect."""
