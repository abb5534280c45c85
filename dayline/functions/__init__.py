"""Column functions: text, URLs, similarity, values and the few Arrow helpers."""
