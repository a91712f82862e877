"""Column helpers: no actions, no joins."""
