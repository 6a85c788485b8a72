"""Readers with declared schemas and versioned writers."""
