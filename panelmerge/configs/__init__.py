"""Ready-made panel configurations."""
