"""Whole jobs: bronze load, silver steps, gold products."""
