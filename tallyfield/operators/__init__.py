"""Frame-level building blocks: ranking, name matching, replace, quality."""
