"""Named queries and jobs."""
