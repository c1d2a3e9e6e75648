"""User-level jobs built from the operators, the query catalog and its SQL oracles."""
