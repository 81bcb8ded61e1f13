"""Specs turned into pipelines, and the jobs that run them."""
