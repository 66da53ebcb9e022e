"""The registered queries, their reference SQL and the adapter from the star tables."""
