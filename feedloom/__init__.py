"""feedloom: raw feeds to queryable tables, as composable DataFrame functions on Spark."""
