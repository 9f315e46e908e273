"""DAG wiring (warehouse) and the analytical queries."""
