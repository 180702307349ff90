"""Compositions of operators: evidence runs, training, registered queries."""
