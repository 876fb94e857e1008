"""Dataflows composed from the operators."""
