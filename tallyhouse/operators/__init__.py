"""DataFrame operators: lazy, no collect, column names passed as parameters."""
