"""Batch order analytics on Spark: typed loads, star schema, marts, checks, late-delivery model, dashboard queries."""
