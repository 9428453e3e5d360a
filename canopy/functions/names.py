"""Name rules as built-in Column expressions (no Python UDFs).

* ``normalise_point``   -- trim + lower-case a point (table) name.
* ``value_column_name`` -- derive the value-column name of a point:
  if the name contains ``ahur`` (any case) take the name from there to the
  end; otherwise the last ``_`` token, or the last two tokens joined by ``_``
  when the last token starts with a digit.  An empty last token (name ending
  in ``_``) falls back to the whole name.  Every character outside
  ``[A-Za-z0-9_]`` becomes ``_`` and the result is lower-cased.
* ``sanitise``          -- the character rule alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
MARKER = "ahur"
NAME_CHARS_OUTSIDE = "[^a-zA-Z0-9_]"
# --- end of fixed values ---


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_point(c) -> Column:
    """``name.strip().lower()``: whitespace trimmed on both ends, lower case."""
    return F.lower(F.regexp_replace(_c(c), r"^\s+|\s+$", ""))


def sanitise(c) -> Column:
    return F.regexp_replace(_c(c), NAME_CHARS_OUTSIDE, "_")


def value_column_name(c) -> Column:
    name = _c(c)
    pos = F.instr(F.lower(name), MARKER)            # 1-based, 0 when absent
    from_marker = F.substr(name, pos)
    parts = F.split(name, "_", -1)
    n = F.size(parts)
    last = F.element_at(parts, -1)
    last_two = F.concat_ws("_", F.element_at(parts, -2), last)
    by_tokens = (F.when(last == "", name)
                 .when(F.substr(last, F.lit(1), F.lit(1)).rlike("^[0-9]$"),
                       F.when(n >= 2, last_two).otherwise(last))
                 .otherwise(last))
    raw = F.when(pos > 0, from_marker).otherwise(by_tokens)
    return F.lower(sanitise(raw))
