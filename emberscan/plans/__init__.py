"""The warehouse models: staging, intermediate, star schema, marts, and how they run."""
