"""Jobs that read, transform, write and audit."""
