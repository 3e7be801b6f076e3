"""docweave: document queries, mutations and corpus preparation as plain Spark DataFrame jobs."""
