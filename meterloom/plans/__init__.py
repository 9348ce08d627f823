"""The composed flows."""
