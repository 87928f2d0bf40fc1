"""Column helpers shared by every plan."""
