"""Storage and execution plans: snapshots, table specs and the run graph."""
