"""Pipeline steps: each takes a State and Params and returns a new State."""
