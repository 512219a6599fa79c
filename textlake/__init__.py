"""textlake: text analytics over labelled document tables, as Spark jobs."""
