"""Names under the ledger's collation (D12): equal without regard to case,
accents and trailing blanks, as in a CI_AI database. The key is a collated
string, so joins and groups compare it that way without a rewritten copy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_COLLATION = "UNICODE_CI_AI_RTRIM"


def name_key(name: Column | str) -> Column:
    return F.collate(name, NAME_COLLATION)
