"""Generic panel operators: cleaning, entity resolution, merge, statistics, ranking."""
