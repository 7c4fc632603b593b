"""Operators of the evidence-grounding engine."""
