"""Column-level functions: scalars (X1-X19) and predicates."""

from colonnade.functions import predicates, scalars

__all__ = ["predicates", "scalars"]
