"""The end-to-end pipeline, the registered queries and their SQL twins."""
