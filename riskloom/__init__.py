"""Loan-portfolio analytics on Spark: profiling, cleaning, scoring, expected loss."""
