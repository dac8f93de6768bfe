"""Corpus cleaning, quality gating and retrieval checks as Spark DataFrame operators."""
