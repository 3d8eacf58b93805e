"""Round-name normalisation (O-49) and vocabulary membership (O-23)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.schemas import FUNDING_ROUNDS, UNKNOWN_ROUND


def in_vocab(c: Column, vocab: Sequence[str] = FUNDING_ROUNDS) -> Column:
    """Case-sensitive membership test (O-23); null stays null."""
    return c.isin(list(vocab))


def fix_round_name(name: Column, vocab: Sequence[str] = FUNDING_ROUNDS) -> Column:
    """Normalise a free-text round name onto the vocabulary (O-49).

    An exact member is kept. Otherwise the first vocabulary entry (in list
    order) whose lower-cased text occurs inside the lower-cased name wins;
    null, empty or unmatched names become ``Unknown``. Built as one CASE chain
    so it stays inside whole-stage codegen.
    """
    low = F.lower(name)
    expr = F.when(in_vocab(name, vocab), name)
    for entry in vocab:
        expr = expr.when(low.contains(entry.lower()), F.lit(entry))
    return expr.otherwise(F.lit(UNKNOWN_ROUND))
