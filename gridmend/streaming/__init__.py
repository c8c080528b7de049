"""Row-local corrections on streaming cubes."""
