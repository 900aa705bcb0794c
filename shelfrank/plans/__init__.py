"""End-to-end flows made of the operators."""
