"""Column expressions and small Arrow-vectorised kernels."""
