"""End-to-end feature builds."""
