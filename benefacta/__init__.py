"""Donor analytics on Spark: cleaning, lifetime value, segmentation, exploration and scoring.

Every operator takes and returns DataFrames. The process date is always an argument.
"""
