"""Model DAG, materialisation, run-then-gate job and the query registry."""
