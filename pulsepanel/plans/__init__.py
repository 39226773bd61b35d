"""Compositions of operators: country plans, the R(t) plan, and the checked queries."""
