"""Models, marts, serving queries, checks and the refresh job."""
