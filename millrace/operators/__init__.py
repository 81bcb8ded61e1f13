"""Preparation, profiling, selection, model and scoring steps."""
