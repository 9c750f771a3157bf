"""What only the driver contract, tests and bench need: fact projections of the
test tables, the request fixture, the registered queries and their oracle SQL.
The engine does not import it."""
