"""String Column helpers: Python-compatible strip, keyword predicates, previews.

All of these compile to built-in Spark expressions (no Python UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The characters Python's ``str.strip()`` removes (``str.isspace()`` is true),
# in code-point order.  Spark's one-argument ``trim`` removes only U+0020.
PY_WS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``s.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(_col(c), F.lit(PY_WS))


def joined_contents(messages, sep: str = " ") -> Column:
    """Contents of a ``messages`` array joined by ``sep`` (keyword text, K1)."""
    return F.array_join(F.transform(_col(messages), lambda m: F.coalesce(m["content"], F.lit(""))), sep)


def any_keyword(text, keywords: Sequence[str], case_sensitive: bool = True,
                word_boundary: bool = False) -> Column:
    """True when any keyword occurs in ``text`` (K1/K2).

    Bare substring test by default, like the reference, so a match may cross
    a message border of the joined text.  ``case_sensitive=False`` lower-cases
    both sides.  ``word_boundary=True`` requires non-word characters (or the
    text edge) around the keyword.
    """
    t = _col(text)
    kws = list(keywords)
    if not kws:
        return F.lit(False)
    if not case_sensitive:
        t = F.lower(t)
        kws = [k.lower() for k in kws]
    if word_boundary:
        import re

        pattern = "(?<![\\p{L}\\p{N}_])(?:" + "|".join(re.escape(k) for k in kws) + ")(?![\\p{L}\\p{N}_])"
        return t.rlike(pattern)
    if len(kws) <= 100:
        cond = F.lit(False)
        for k in kws:
            cond = cond | t.contains(F.lit(k))
        return cond
    # Long lists: one array literal and a higher-order ``exists``.
    arr = F.array(*[F.lit(k) for k in kws])
    return F.exists(arr, lambda k: F.instr(t, k) > 0)


def preview(c, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_col(c), 1, n)
