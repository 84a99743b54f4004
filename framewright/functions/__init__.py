"""Column functions: rounding, identifiers, text, geometry, canvases."""
