"""Column expressions: words, labels and sparse-vector conversions."""
