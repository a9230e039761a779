"""lakeferry: catalog-migration analytics as set-based Spark jobs."""
