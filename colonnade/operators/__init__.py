"""DataFrame operators: ``f(df, ...) -> DataFrame``, lazy, no collect inside
(except documented lineage cuts for iterative searches)."""
