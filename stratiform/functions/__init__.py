"""functions of the cohort library."""
