"""Contract instances, named queries, their SQL oracle and the end-to-end job."""
