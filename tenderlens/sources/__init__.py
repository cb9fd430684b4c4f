"""Readers, writers and the contract view over the test tables."""
