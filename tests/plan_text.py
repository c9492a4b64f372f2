"""The printed plan of a table."""

import contextlib
import io


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
