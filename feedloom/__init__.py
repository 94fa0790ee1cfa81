"""feedloom: event-feed analytics on PySpark."""
