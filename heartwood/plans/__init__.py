"""The query catalogue: operators bound to the driver's tables, with their SQL."""
