"""Composite jobs: customer mart, event split, item matrix, features, classifier."""
