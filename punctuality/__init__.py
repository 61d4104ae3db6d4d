"""Punctuality analytics on Spark: delays, their causes and late-arrival prediction."""
