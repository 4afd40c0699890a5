"""Column-to-Column helpers; everything stays inside Catalyst."""
