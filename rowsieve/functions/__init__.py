"""Column functions and record generators."""
