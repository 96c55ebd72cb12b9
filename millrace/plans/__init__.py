"""Config model, validation and jobs."""
