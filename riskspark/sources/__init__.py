"""Readers of samples, dictionaries, metadata, configuration, models and scorecards."""
