"""The lake's tables: how each layer is computed from the one below."""
