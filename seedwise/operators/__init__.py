"""DataFrame operators: encoders, populations, models, evaluation, ranking."""
