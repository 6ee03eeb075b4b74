"""Insert-if-absent: the first write of a key wins, later ones change nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.dedup import DUPLICATE, flag_duplicates
from sluice.session import as_large, stage


def absent_rows(
    new: DataFrame, existing: DataFrame, key: str, order: str | Column | None = None
) -> DataFrame:
    """Rows of ``new`` whose key ``existing`` lacks; of equal new keys the first by ``order``.

    ``order`` must be unique within a key.

    The existing table is reduced to the keys the new rows carry before it
    meets them.  Those keys are staged, so that their size is known: a batch
    of few keys is broadcast against a scan of the key column and the table
    is not shuffled, a larger one is joined by a shuffle.
    """
    if order is not None:
        by = F.col(order) if isinstance(order, str) else order
        new = flag_duplicates(new, {key: F.col(key)}, by).where(~F.col(DUPLICATE))
        new = new.drop(DUPLICATE)
    wanted = stage(new.select(key).distinct(), "wanted_keys")
    met = existing.select(key).join(as_large(wanted, meets_wide=False), key, "left_semi")
    known = stage(met.distinct(), "known_keys")
    return new.join(as_large(known), key, "left_anti")


def append_new(
    master: DataFrame, new: DataFrame, key: str, order: str | Column | None = None
) -> DataFrame:
    """The master table followed by the new rows it lacks."""
    return master.unionByName(
        absent_rows(new, master, key, order).select(*master.columns), allowMissingColumns=True
    )
