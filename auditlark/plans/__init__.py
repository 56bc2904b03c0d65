"""Whole audits and evaluations composed from the operators."""
