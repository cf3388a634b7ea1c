"""Writers for batch tables."""
