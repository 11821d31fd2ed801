"""End-to-end verbs composed from the operators."""
