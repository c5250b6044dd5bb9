"""Column functions: keys, topology, projection, elevation, predicates, hashes."""
