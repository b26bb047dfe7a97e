"""Readers, writers, connector options, derived inputs and the stepped-counter source."""
