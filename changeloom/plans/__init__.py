"""What to load (specs) and the batch jobs that load it."""
