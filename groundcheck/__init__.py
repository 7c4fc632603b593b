"""Evidence grounding over whole corpora, as Spark DataFrame operators."""
