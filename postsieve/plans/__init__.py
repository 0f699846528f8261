"""End-to-end corpus builds."""
