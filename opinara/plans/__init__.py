"""Jobs composed of operators, and the queries registered for the driver."""
