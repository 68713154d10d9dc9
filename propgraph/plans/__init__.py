"""Plans: the graph spec, the canonicalize stage and the whole pipeline."""
