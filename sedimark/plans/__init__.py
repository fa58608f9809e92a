"""Compositions: marts, served pages, learning and the jobs that run them."""
