"""Readers for fact shards, stored tables and databases."""
