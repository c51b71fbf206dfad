"""End-to-end plans, the query registry and its reference SQL."""
