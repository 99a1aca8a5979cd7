"""Which labelled rows are held out of every fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_held_out(doc_id: Column) -> Column:
    """True where crc32 of the id, written as text, leaves remainder 2 by 4; null ids: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
