"""Whole queries: the star schema, roll-ups and the queries over the supplied tables."""
