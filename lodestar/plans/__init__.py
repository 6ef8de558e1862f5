"""Query plans: reporting views, named reads, guarded SQL, the full run."""
