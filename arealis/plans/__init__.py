"""User-facing queries composed of the operators."""
