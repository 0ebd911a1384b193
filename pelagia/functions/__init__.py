"""Column expressions over lines, messages and tags."""
