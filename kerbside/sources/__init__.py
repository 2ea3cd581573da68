"""Landing-file readers, the raw/prod tables and the run log."""
