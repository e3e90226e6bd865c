"""End-to-end loads and mart queries."""
