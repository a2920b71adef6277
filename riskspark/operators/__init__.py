"""Operators on lazy DataFrames: running sums, curves, bins, stability, WOE, joins, checks, comparison, scoring, scorecards."""
