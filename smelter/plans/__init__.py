"""The layers: silver tables, gold star schema, saved queries, and the run that builds them."""
