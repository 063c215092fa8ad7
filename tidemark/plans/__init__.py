"""Entity declarations, aggregates and the staged run."""
