"""Relational building blocks: filters (P), joins (J), aggregations (A),
the decline rule (W1), ordering/top-N/unions (O, U) and currency (J12)."""
