"""DataFrame -> DataFrame operators, identical for batch and streaming input."""
