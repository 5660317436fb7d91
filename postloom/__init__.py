"""Weekly topic and trend analytics over large collections of short posts, on Spark."""
