"""Column builders: text, vectors and identifiers."""
