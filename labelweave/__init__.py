"""Structured address tables to labelled token data and back, as Spark jobs."""
