"""Finished questions and report datasets built from the operators."""
