"""Plans: fixtures, the end-to-end flow, the query registry and its SQL oracle."""
