"""Makes the package importable for tests, wherever pytest is started."""
