"""Named queries over a table directory and their SQL oracles."""
