"""Silver and gold tables, serving views, measures and incremental loads."""
