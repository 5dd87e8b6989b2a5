"""Log, run and batch tables derived from the test tables, and the queries checked on them."""
