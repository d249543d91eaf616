"""Whole data flows: the match-results layers and the registered queries on the test tables."""
