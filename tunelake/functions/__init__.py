"""Column expressions: text, templates, strict JSON, paths."""
