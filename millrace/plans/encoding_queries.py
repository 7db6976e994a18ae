"""The registered query of encoding repair, with its SQL: documents are damaged in known ways and come back as they were."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import functions as F

from ..functions import text as X
from .catalogue import _clean_sql, _q, _t

_LETTERS = "éóèñçüêäöíÉÈÑÓÇÄÜÖÊÍ"


def _misread(c, layers: int):
    """UTF-8 read as ISO 8859-1, some times over; nothing that does not fit is there."""
    for _ in range(layers):
        c = F.decode(F.encode(c, "utf-8"), "iso-8859-1")
    return c


def _damaged(c):
    apart = reduce(lambda t, a: F.replace(t, F.lit(a), F.lit(unicodedata.normalize("NFD", a))), _LETTERS, c)
    kind = F.col("doc_id") % 5
    return F.when(kind == 0, _misread(c, 1)).when(kind == 1, _misread(c, 3)).when(kind == 2, apart).when(kind == 3, F.translate(F.replace(c, F.lit("\n"), F.lit("\r\n")), "'\"", "’“")).otherwise(c)


@_q(f"SELECT doc_id, {_clean_sql('nfc_normalize(text)')} AS text FROM documents")
def encoding_repair(spark, sf_dir):
    """The whole cleaning chain over texts that were read as another encoding, decomposed or typeset."""
    return _t(spark, sf_dir, "documents").select("doc_id", X.clean_text(_damaged(F.col("text"))).alias("text"))
