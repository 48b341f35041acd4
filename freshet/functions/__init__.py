"""Column functions: planar geometry, projections, formatting."""
