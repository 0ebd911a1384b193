"""The optional append-only streaming path."""
