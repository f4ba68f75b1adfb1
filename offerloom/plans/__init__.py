"""Named queries over the bound tables, each with its SQL twin where SQL can express it."""
