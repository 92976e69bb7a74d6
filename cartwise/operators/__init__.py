"""Operators: features, training table, scoring/recommendation, evaluation, model, EDA."""
