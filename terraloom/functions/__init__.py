"""Column functions: geodesy, rotations and numeric helpers, all inside code generation."""
