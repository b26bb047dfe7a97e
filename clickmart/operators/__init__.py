"""DataFrame -> DataFrame operators: visits, pivots, metrics, item matrices, events, checks."""
