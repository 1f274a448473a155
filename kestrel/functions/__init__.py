"""Column helpers: score buckets, ranges and URLs, dates."""
