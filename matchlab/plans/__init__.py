"""Compositions of operators: the feature build, training and scoring
runs, and the catalog of registered queries."""
