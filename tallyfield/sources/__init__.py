"""Reading landing data and rank files, and the season-partitioned store."""
