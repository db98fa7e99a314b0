"""marquee: event-listing curation as Spark DataFrame jobs."""
