"""Sources (driver tables, dirty derivations, fixtures) and sinks."""
