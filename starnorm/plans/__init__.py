"""Declarative stars and the jobs that run them."""
