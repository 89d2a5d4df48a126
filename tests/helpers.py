"""Small helpers shared by the tests."""

import contextlib
import io


def rows(df, *order):
    """Rows as plain tuples, sorted by ``order`` or by everything."""
    found = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return found if order else sorted(found, key=repr)


def plan(df) -> str:
    """The physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
