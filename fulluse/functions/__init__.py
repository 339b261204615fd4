"""Pure column functions."""
