"""Physical choices made from measured sizes, and the registry of named queries."""
