"""Jobs composed of the operators, and the query catalogue over the driver's tables."""
