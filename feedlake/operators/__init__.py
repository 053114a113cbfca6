"""DataFrame steps that make up the jobs."""
