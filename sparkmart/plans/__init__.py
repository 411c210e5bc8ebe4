"""Whole jobs: raw documents to processed tables to the star schema."""
