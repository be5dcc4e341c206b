"""Evidence analytics on Spark: relational, text and table operators over planning documents."""
