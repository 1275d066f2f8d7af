"""operators of the cohort library."""
