"""Business queries built from the operators."""
