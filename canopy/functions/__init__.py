"""canopy.functions."""
