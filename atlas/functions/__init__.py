"""Column functions: text keys, geometry, map-object tags, ids."""
