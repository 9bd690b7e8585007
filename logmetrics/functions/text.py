"""String helpers: payload size, zero-padded ids, templated series labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_bytes(cols: list[str]) -> Column:
    """Bytes of the producer's JSON payload for a flat ASCII record made of ``cols``.

    ``to_json`` writes ``","`` and ``":"``; the producer's encoder writes ``", "`` and
    ``": "``, so each of the *k* non-null keys adds one byte after its colon and each of
    the *k-1* separators one more.  ``to_json`` drops null fields, which matches keys the
    producer never sets.
    """
    k = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in cols[1:]),
            F.when(F.col(cols[0]).isNotNull(), 1).otherwise(0))
    compact = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in cols])))
    return (compact + F.greatest(F.lit(0), 2 * k - 1)).cast("long")


def zero_padded(prefix: str, col, width: int = 8) -> Column:
    """``prefix`` + id zero-padded to ``width`` digits; longer ids are kept whole."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"{prefix}%0{width}d", c.cast("long"))


def series_label(template: str, **cols) -> Column:
    """Render a legend template such as ``'{service} - {level}'`` from columns."""
    parts: list[Column] = []
    rest = template
    while rest:
        i = rest.find("{")
        if i < 0:
            parts.append(F.lit(rest))
            break
        j = rest.index("}", i)
        if i:
            parts.append(F.lit(rest[:i]))
        name = rest[i + 1 : j]
        parts.append(F.coalesce(F.col(cols.get(name, name)).cast("string"), F.lit("")))
        rest = rest[j + 1 :]
    return F.concat(*parts)


def significant(col: Column, digits: int = 9) -> Column:
    """``col`` rounded to ``digits`` significant digits.  Sums of doubles depend in their
    last bits on the order in which partial sums are merged; results that are compared
    by hash are rounded by this, once, at the end.  NULL and NaN stay."""
    return F.when(F.isnan(col), col).otherwise(F.format_string(f"%.{digits - 1}e", col).try_cast("double"))
