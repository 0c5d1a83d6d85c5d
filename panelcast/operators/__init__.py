"""DataFrame operators; each takes and returns DataFrames and composes with ``transform``."""
