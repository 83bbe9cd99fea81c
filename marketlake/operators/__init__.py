"""DataFrame operators: pure functions, no paths, no session configuration."""
