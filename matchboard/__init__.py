"""Match, rating and leaderboard analytics as Spark DataFrame operators."""
