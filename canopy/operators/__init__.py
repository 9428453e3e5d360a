"""canopy.operators."""
