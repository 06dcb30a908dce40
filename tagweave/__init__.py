"""User-profile tagging and stream metrics as plain Spark DataFrame functions."""
