"""tickwell: daily market-bar warehouse on Spark (bronze, silver, gold, indicators, gates, extracts)."""
