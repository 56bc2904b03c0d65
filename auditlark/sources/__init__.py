"""Reading tables, documents, request logs and saved reports; writing results."""
