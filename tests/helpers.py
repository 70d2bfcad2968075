"""Rows as plain tuples, and plans as text."""

import contextlib
import datetime as dt
import io


def rows(df, *columns):
    """Sorted tuples of the named columns (all by default)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def ts(text):
    return dt.datetime.fromisoformat(text)
