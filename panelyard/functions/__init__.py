"""Column functions: conversions, domain derivations and entity windows."""
