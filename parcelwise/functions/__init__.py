"""Column expressions. Everything here returns a ``Column`` and stays inside whole-stage code generation."""
