"""A/B experiment analysis: per-user metrics, splits, tests, resampling and
distribution summaries.  Every test is a conditional aggregation over the
per-user table (one pass for both groups); only the final one-row-per-test
statistics cross into Python for the p-value."""
