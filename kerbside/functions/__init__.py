"""Column-level building blocks; everything here stays inside whole-stage codegen."""
