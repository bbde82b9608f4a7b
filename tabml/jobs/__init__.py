"""Command-line jobs: ``python -m tabml.jobs.train`` and ``python -m tabml.jobs.score``."""
