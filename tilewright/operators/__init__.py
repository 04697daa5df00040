"""DataFrame operators: joins, metrics, relations, clipping and validation."""
