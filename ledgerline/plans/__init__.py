"""Stage runs over the store, derived feeds, registered queries and their SQL."""
