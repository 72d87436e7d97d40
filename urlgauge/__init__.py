"""URL-risk analytics on Spark."""
