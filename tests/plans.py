"""Look at physical plans."""

import contextlib
import io


def explained(df, mode="simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
