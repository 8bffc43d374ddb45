"""Jobs composed of operators, each reading and writing tables."""
