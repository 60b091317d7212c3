"""Reader policies: which rows and columns a group of readers gets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.context import GROUP_DOMAINS

# Groups that may read a unit price, and groups that may read mart rows at all.
COST_READERS = ("procurement_team", "management", "data_analysts")
ROW_READERS_ALL = ("management", "data_analysts")
ROW_READERS_KEYED = ("procurement_team", "plm_engineers")


def mask_columns(df: DataFrame, readers: Mapping[str, Sequence[str]], groups: Sequence[str]) -> DataFrame:
    """Null out every column in ``readers`` that none of the reader's groups may see."""
    member = F.array(*[F.lit(g) for g in groups]).cast("array<string>")
    masked = {
        c: F.when(F.arrays_overlap(member, F.array(*[F.lit(a) for a in allowed])), F.col(c))
        for c, allowed in readers.items()
    }
    return df.select([masked[c].alias(c) if c in masked else F.col(c) for c in df.columns])


def filter_rows(df: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """Full readers see every row, keyed readers the rows that have a key, others none."""
    if set(groups) & set(ROW_READERS_ALL):
        return df
    if set(groups) & set(ROW_READERS_KEYED):
        return df.where(F.col(key).isNotNull())
    return df.where(F.lit(False))


def filter_domains(df: DataFrame, domain: str, group: str) -> DataFrame:
    """Rows of the data domains the group may see."""
    return df.where(F.col(domain).isin(GROUP_DOMAINS.get(group, [])))
