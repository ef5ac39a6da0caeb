"""Reading and writing tables, and the star-schema view."""
