"""Staging views and gold marts, each a pure DataFrame -> DataFrame function."""
