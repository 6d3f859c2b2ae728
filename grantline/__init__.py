"""Access-rights analytics on Spark: principals, storage access, privileges, volumes and allowlists."""
