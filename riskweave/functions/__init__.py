"""Column functions: each takes and returns ``Column`` and stays inside code generation."""
