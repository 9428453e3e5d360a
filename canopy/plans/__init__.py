"""canopy.plans."""
