"""Multi-operator plans: feature table, models, scoring, money, reports."""
