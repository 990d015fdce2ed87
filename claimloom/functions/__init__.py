"""Column-to-column functions: cleaning rules, fixed vocabularies, exact money arithmetic."""
