"""End-to-end jobs, the domain views over the driver tables, and the catalogue."""
