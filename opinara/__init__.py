"""Comment-mood analytics on Spark: intake, scoring, counters, sampling and evaluation."""
