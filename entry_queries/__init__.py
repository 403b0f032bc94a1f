"""The registered queries: library operators over the driver's tables, each with its SQL twin."""
