"""Table operators, one module per step of the analysis."""
