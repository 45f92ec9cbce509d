"""Whole jobs: market layers, movies report, flight lake, pair universe, schema report."""
