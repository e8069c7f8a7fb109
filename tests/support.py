"""Helpers that tests import by a name of their own."""


def rows(df, *columns):
    """Sorted plain tuples of a frame."""
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
