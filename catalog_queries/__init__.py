"""Queries over the star-schema tables: each is a library operator applied to whole tables."""
