"""vecflow: moving and checking vector collections as Spark jobs."""
