"""Layer plans: whole steps composed of operators."""
