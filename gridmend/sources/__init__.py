"""Reading and writing cubes and their attributes."""
