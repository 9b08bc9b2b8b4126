"""Résumé signals and corpus preparation on Spark."""
