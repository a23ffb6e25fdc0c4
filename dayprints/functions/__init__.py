"""Column functions: time, geometry and sensor fields."""
