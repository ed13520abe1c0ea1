"""Readers, writers and the claim views over the benchmark tables."""
