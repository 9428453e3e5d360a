"""canopy.streaming."""
