"""UTF-8 text that was read as Windows-1252, put right inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the characters that Windows-1252 has where Latin-1 has controls, and those controls
WINDOWS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CONTROLS = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
#: The characters of a UTF-8 sequence of two to four bytes, read one by one.
SEQUENCE = "(?:[Â-ß][\u0080-¿]|[à-ï][\u0080-¿]{2}|[ð-ô][\u0080-¿]{3})"
#: Text is read wrongly at most so often in a row.
LAYERS = 2


def as_bytes(value: Column) -> Column:
    """The text with each character standing for the byte it was read from."""
    return F.translate(value, WINDOWS, CONTROLS)


def misread(value: Column) -> Column:
    """Every character beyond ASCII is part of such a sequence, and there is one."""
    rest = F.regexp_replace(as_bytes(value), SEQUENCE, "")
    return ~rest.rlike(r"[^\x00-\x7F]") & value.rlike(r"[^\x00-\x7F]")


def repaired(value: Column) -> Column:
    """The text as it was written; what cannot have been read so stays as it is, null stays null."""
    out = value
    for _ in range(LAYERS):
        out = F.when(misread(out), F.decode(F.encode(as_bytes(out), "ISO-8859-1"), "UTF-8")).otherwise(out)
    return out
