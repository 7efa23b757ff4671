"""A row-change log derived from the driver's tables, and the registered queries over it with their SQL."""
