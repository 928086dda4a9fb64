"""End-to-end workflows and the catalogue of registered queries."""
