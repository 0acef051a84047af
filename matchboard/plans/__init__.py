"""Models, jobs and synthetic data."""
