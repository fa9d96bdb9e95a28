"""newsfold: messy mention feeds to one duplicate-free table, and questions over it, as Spark jobs."""
