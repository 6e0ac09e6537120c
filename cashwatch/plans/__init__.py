"""Compositions of operators: the daily snapshot and the whole monitoring run."""
