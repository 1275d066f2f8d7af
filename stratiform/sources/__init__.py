"""sources of the cohort library."""
