"""The run from lock to publish, and the registered queries."""
