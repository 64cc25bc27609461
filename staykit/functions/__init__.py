"""Column functions: every one returns a Column and stays inside whole-stage codegen."""
