"""DataFrame operators: cleaning, state, fact, star schema, marts, checks."""
