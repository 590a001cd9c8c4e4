"""String columns that treat Unicode the way the engine's texts need it."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All white space characters of Unicode, in order.
BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def trimmed(column: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.trim(F.col(column) if isinstance(column, str) else column, F.lit(BLANKS))


def filled(column: Column | str) -> Column:
    """Trimmed; null where nothing is left."""
    return F.nullif(trimmed(column), F.lit(""))


@cache
def _folding() -> tuple[str, str]:
    """Letters with marks and their bare lower-case letters, by Unicode decomposition."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        bare = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if len(bare) == 1 and bare.isascii() and bare.isalpha():
            source.append(chr(code))
            target.append(bare)
    return "".join(source), "".join(target)


def folded(column: Column) -> Column:
    """Lower case without accents, in the JVM: combining marks are removed, accented Latin letters become bare ones."""
    source, target = _folding()
    return F.regexp_replace(F.translate(F.lower(column), source, target), r"\p{M}+", "")
