"""canopy.sources."""
