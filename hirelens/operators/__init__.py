"""Relational operators: grouped metrics, term ranking, features, folds and samples, scoring."""
