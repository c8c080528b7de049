"""DataFrame -> DataFrame operators on long-form cubes."""
