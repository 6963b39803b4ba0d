"""DataFrame operators: joins, windows, scorers, methylation, gene models, statistics."""
