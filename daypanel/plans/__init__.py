"""Operators composed into the dataset, the staged job and the registered queries."""
