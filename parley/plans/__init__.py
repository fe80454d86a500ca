"""End-to-end plans composed from operators, and the query catalog."""
