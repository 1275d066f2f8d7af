"""plans of the cohort library."""
