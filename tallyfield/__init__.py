"""Season statistics on Spark: load, score, rank, match, summarise, profile, query."""
