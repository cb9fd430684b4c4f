"""Composite jobs: cleaning, identities, places, risk, panels and models."""
