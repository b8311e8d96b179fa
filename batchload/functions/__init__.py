"""Small column helpers shared by the planner and the operators."""
