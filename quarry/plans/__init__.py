"""Plans: the warehouse analog over the test tables, the composed reports and
model jobs built from the operators, the query registry (``registry.queries``)
and the DuckDB oracle statements (``oracle.oracle_sql``)."""
