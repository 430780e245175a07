"""Continuous collection over a landing folder."""
