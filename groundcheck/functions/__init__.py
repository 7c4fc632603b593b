"""Functions of the evidence-grounding engine."""
