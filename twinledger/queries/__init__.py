"""Registered queries: every operator run over the given tables, with the SQL that must agree with it."""


def load() -> None:
    """Import all query modules, which register themselves."""
    from twinledger.queries import catalogs, extracts, inputs, runs, settings, status, tables  # noqa: F401
