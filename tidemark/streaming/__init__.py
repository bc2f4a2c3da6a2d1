"""Stream forms of the stateful operators."""
