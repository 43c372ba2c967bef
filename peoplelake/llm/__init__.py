"""Training-data operators: deduplication, filtering, archives, sharding, mixing and token encoding as Spark jobs."""
