"""Column functions: geometry, scalars and the SQL registrations."""
