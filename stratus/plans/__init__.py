"""Query plans: fixture views over the star-schema tables, one function per key."""
