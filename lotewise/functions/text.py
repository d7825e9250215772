"""Text folding and `;` lists."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented lower-case letters and the plain letter each is read as.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "aaaaaeeeeiiiiooooouuuucn"


def fold(col: Column | str) -> Column:
    """Lower case, no accents, outer spaces gone, inner runs of spaces made one;
    no-break spaces are spaces."""
    text = col if isinstance(col, Column) else F.col(col)
    return F.translate(F.lower(F.trim(F.regexp_replace(text, r"[\s\u00A0\u202F\u2007]+", " "))), ACCENTED, PLAIN)


def fold_label(col: Column | str) -> Column:
    """A printed label as it is compared: folded, `°`/`º` dropped, no closing `:`."""
    return F.trim(F.regexp_replace(fold(col), r"[°º.]|:\s*$", ""))


def fold_label_py(label: str) -> str:
    """The same folding as `fold_label`, for the short lists the caller writes."""
    text = re.sub(r"\s+", " ", label).strip().lower().translate(str.maketrans(ACCENTED, PLAIN))
    return re.sub(r"[°º.]|:\s*$", "", text).strip()


def slug(col: Column | str) -> Column:
    """A caption as it may appear in a file name."""
    return F.trim(F.regexp_replace(fold(col), r"[^a-z0-9]+", "_"), F.lit("_"))


def split_list(col: Column | str) -> Column:
    """Text separated by `;` to an array of distinct, trimmed, non-empty items."""
    text = col if isinstance(col, Column) else F.col(col)
    items = F.transform(F.split(text, ";"), lambda item: F.trim(item))
    return F.array_distinct(F.filter(items, lambda item: item != ""))


def join_list(col: Column | str) -> Column:
    """The array back to the text that is stored."""
    return F.array_join(col, ";")
