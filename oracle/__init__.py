"""Checked queries and their reference SQL."""


def load_all():
    from oracle import contexts, metrics, quality, sources, star  # noqa: F401
    from oracle.catalog import QUERIES

    return QUERIES
