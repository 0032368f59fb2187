"""tillflow: retail events from raw messages to business tables, as Spark jobs."""
