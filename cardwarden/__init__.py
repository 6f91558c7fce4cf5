"""Account-takeover and card-risk analytics as composable Spark jobs."""
