"""Models: staging, intermediate, dimensions, facts, metrics, quality checks."""
