"""Moving and relinking large graphs of related records between two systems, on Spark."""
