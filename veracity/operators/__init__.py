"""DataFrame operators: preparation, evaluation, drift, features, models."""
