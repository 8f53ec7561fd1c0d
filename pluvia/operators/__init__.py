"""DataFrame operators: joins, aggregates, ordered windows, sketch, models."""
