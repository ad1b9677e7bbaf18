"""DataFrame operators: parsing, search, aggregation, ordered features, alerts, models."""
