"""Relational building blocks shared by the models, measures and checks."""
