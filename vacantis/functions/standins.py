"""Blank and stand-in values: typed to say that nothing is known."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what people type where they know nothing, lower-cased, with blanks and signs left out
STAND_INS = "0 00 000 na nil none null nan nothing unknown unk undefined tba tbd tbc tbh pending notspecified notapplicable notavailable notknown notprovided notgiven notmentioned notsure notset notdisclosed unspecified unavailable undisclosed tobeannounced tobedecided tobeconfirmed tobedetermined tobeadvised toconfirm dummy test xx xxx xxxx abc asdf blank empty missing noidea noname dontknow seeabove seebelow asabove sameasabove".split()


def bare(value: Column) -> Column:
    """Lower-cased letters and digits only."""
    return F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}\p{M}]+", ""))


def says_nothing(value: Column) -> Column:
    """True for null, blank, signs only, and stand-ins."""
    b = bare(value)
    return value.isNull() | (b == "") | b.isin(STAND_INS)
