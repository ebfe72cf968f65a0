"""Column expressions and schema helpers; nothing here starts a job."""
