"""The models (M1-M16), profiling queries (R), scale variants (X), pipeline."""
