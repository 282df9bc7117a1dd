"""Table operators that work on any DataFrame."""
