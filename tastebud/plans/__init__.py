"""Query plans: the pipeline bound to the test tables, the query registry and
the SQL oracle statements that check it."""
