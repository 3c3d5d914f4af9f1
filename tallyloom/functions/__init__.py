"""Column functions.  All are built-in expressions; none calls Python per row."""
