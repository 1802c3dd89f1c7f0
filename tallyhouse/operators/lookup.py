"""Left joins of a fact table to its dimensions.

Every lookup of a whole dimension is a plain left join without a hint: the planner broadcasts a dimension within the session's limit, adaptive
execution does so once a size is known, and beyond it both sides are shuffled by the key. A key that holds a third of
the facts, and the facts without a key, each fall into one shuffle partition, which adaptive execution splits by map tasks
(``spark.sql.adaptive.skewJoin``): it may split the fact side of a left join whatever the key. Nothing is measured and no job
runs while a plan is built. Every fact row is kept exactly once.

What the facts carry from one shuffle to the next counts for every later one. So the dimension with the most columns comes last, and a
dimension's key is not carried beside the fact's: a flag says whether there was a match, and the key is set from it at the end.

Dimension keys have to be unique (see ``current_snapshot``); a repeated key repeats fact rows, as in any join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types of which equal values are the same value, so that a matched key may stand for the other side's.
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


@dataclass(frozen=True)
class Lookup:
    """One dimension to attach: ``fact_key = dim_key``, and the dimension's columns with their output names.

    ``attached`` are lookups for the dimension itself, by its output names. ``large`` is for a dimension that grows with
    the business: it is joined while the facts are narrow, as it may shuffle them. ``colocated`` is for one stored in the
    same buckets as the facts: it is joined before any other shuffles them. ``bounded`` is for rows whose number does not grow
    with the data: they are broadcast.
    """

    dim: DataFrame
    fact_key: str
    dim_key: str
    columns: Mapping[str, str]
    attached: Sequence[Lookup] = ()
    large: bool = False
    colocated: bool = False
    bounded: bool = False

    def outputs(self) -> list[str]:
        return [*self.columns.values(), *(name for lookup in self.attached for name in lookup.outputs())]


def _key(lookup: Lookup, position: int) -> str:
    """Name of a dimension's key during the join; distinct also from those of attached lookups."""
    return f"__{lookup.fact_key}_{position}"


def _exact(kind: T.DataType) -> bool:
    return isinstance(kind, EXACT) or kind == T.StringType()


def _key_copy(fact: DataFrame, lookup: Lookup) -> str | None:
    """The output that repeats the fact's key where the dimension has a row, if it need not be carried."""
    out = lookup.columns.get(lookup.dim_key)
    kinds = fact.schema[lookup.fact_key].dataType, lookup.dim.schema[lookup.dim_key].dataType
    carried = any(attached.fact_key == out for attached in lookup.attached)
    return out if kinds[0] == kinds[1] and _exact(kinds[0]) and not carried else None


def star_join(fact: DataFrame, lookups: Sequence[Lookup], where: Column | None = None) -> DataFrame:
    """Attach the columns of every lookup to the fact rows by left joins.

    Lookup keys have to be columns of ``fact``. ``where`` may use the columns of the first lookup, which is then joined
    before all others, so that the rest meets only the rows kept. Of the others the large dimensions come first, those
    with few columns ahead: they shuffle the fact rows, which are still narrow then.
    """
    order = sorted(
        range(len(lookups)),
        key=lambda i: (where is not None and i != 0, not lookups[i].colocated, not lookups[i].large, len(lookups[i].outputs())),
    )
    joined, made = fact, {}
    for i in order:
        lookup, key = lookups[i], _key(lookups[i], i)
        copy = _key_copy(fact, lookup) if lookup.large and not (where is not None and i == 0) else None
        columns = [F.col(f"`{c}`").alias(out) for c, out in lookup.columns.items() if out != copy]
        if copy:
            columns.append(F.lit(True).alias(f"{key}_matched"))
            made[copy] = F.when(F.col(f"`{key}_matched`"), F.col(f"`{lookup.fact_key}`"))
        dim = lookup.dim.select(F.col(f"`{lookup.dim_key}`").alias(key), *columns)
        dim = star_join(dim, lookup.attached) if lookup.attached else dim
        dim = F.broadcast(dim) if lookup.bounded else dim
        joined = joined.join(dim, F.col(f"`{lookup.fact_key}`") == F.col(key), "left")
        if where is not None and i == 0:
            joined = joined.where(where)
    outputs = [out for lookup in lookups for out in lookup.outputs()]
    return joined.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in [*fact.columns, *outputs]])
