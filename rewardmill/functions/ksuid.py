"""K-sortable ids: 27 base-62 digits of a 32-bit second count and a 128-bit payload."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the id format.
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LENGTH = 27
EPOCH = 1_400_000_000
LARGEST = "aWgEPTl1tmebfsQzFP4bxwgy80V"

_LIMBS = 5


def well_formed(ident: Column) -> Column:
    """27 base-62 digits that don't exceed 160 bits (digits sort as their values do)."""
    return F.coalesce(ident.rlike(f"^[0-9A-Za-z]{{{LENGTH}}}$") & (ident <= F.lit(LARGEST)), F.lit(False))


def seconds(ident: Column) -> Column:
    """Unix seconds of an id; null where it isn't well formed.

    Long multiplication in five 32-bit limbs, folded over the digits: no UDF needed.
    """
    digits = F.transform(F.split(F.substring(ident, 1, LENGTH), ""), lambda c: (F.instr(F.lit(ALPHABET), c) - 1).cast("long"))
    word = F.lit(1 << 32)

    def push(limbs: Column, digit: Column) -> Column:
        carry, out = digit, [None] * _LIMBS
        for k in reversed(range(_LIMBS)):
            value = limbs[k] * 62 + carry
            out[k], carry = F.pmod(value, word), F.shiftright(value, 32)
        return F.array(*out)

    zero = F.array(*[F.lit(0).cast("long")] * _LIMBS)
    # one step a digit over named limbs would copy expressions; the fold keeps one row value
    top = F.aggregate(digits, zero, push, lambda limbs: limbs[0])
    return F.when(well_formed(ident), top + EPOCH)


def is_valid(ident: Column, now: Column | float) -> Column:
    """Well formed and not later than ``now`` (unix seconds).

    Ids sort as their times do: against a known second it is a comparison of strings, which
    decodes nothing; only a time by row needs the id's own.
    """
    if isinstance(now, Column):
        return well_formed(ident) & F.coalesce(seconds(ident) <= now, F.lit(False))
    after = math.floor(now) + 1
    if after <= EPOCH:
        return F.lit(False)
    if after - EPOCH >= 1 << 32:
        return well_formed(ident)
    return well_formed(ident) & F.coalesce(ident < F.lit(lower_bound(after)), F.lit(False))


def iso_basic(ident: Column) -> Column:
    """UTC time of an id as YYYYmmddTHHMMSSZ, whatever the session's time zone."""
    # a lambda's argument is computed once, a column's expression at each of its uses
    return F.get(F.transform(F.array(seconds(ident)), iso_basic_seconds), F.lit(0))


def iso_basic_seconds(unix: Column) -> Column:
    days = F.floor(unix / 86_400).cast("int")
    left = F.pmod(unix, F.lit(86_400))
    clock = F.format_string("%02d%02d%02d", F.floor(left / 3600), F.floor(F.pmod(left, F.lit(3600)) / 60), F.pmod(left, F.lit(60)))
    return F.concat(F.date_format(F.date_from_unix_date(days), "yyyyMMdd"), F.lit("T"), clock, F.lit("Z"))


def lower_bound(unix: int) -> str:
    """Smallest id of a second: turns a time predicate into a string range on ids, which
    parquet statistics can prune."""
    value, out = (unix - EPOCH) << 128, []
    for _ in range(LENGTH):
        value, digit = divmod(value, 62)
        out.append(ALPHABET[digit])
    return "".join(reversed(out))
