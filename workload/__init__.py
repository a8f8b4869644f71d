"""Registered queries: Spark functions and the SQL that checks them."""


def load():
    from . import joins, kernels, loops, registry, tables  # noqa: F401

    return registry.QUERIES, registry.ORACLES
