"""DataFrame operators: filters and key joins, aggregates, profile, geometry, previews."""
