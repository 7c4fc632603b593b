"""Sources of the evidence-grounding engine."""
