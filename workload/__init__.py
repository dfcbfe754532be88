"""The registered queries: every operator on the shared test tables, next to its SQL."""
