"""streaming of the cohort library."""
