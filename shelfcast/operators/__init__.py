"""Relational building blocks: joins, order, fills, lags, profiles, folds."""
