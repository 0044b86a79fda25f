"""Plans: bindings to the driver tables, the registered queries, their oracles
and the multi-output report job."""
