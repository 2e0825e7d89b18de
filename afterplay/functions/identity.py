"""Which field of a record names its player."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Id fields in order of precedence.
ID_FIELDS = ("device_id", "uid", "player_id")

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def id_text(value: Column, name: str) -> Column:
    """A JSON value of the id field ``name`` as text.

    The number zero and false are no ids, but for the last field, where they count.
    """
    text = F.try_variant_get(value, "$", "string")
    if name == ID_FIELDS[-1]:
        return text
    kind = F.schema_of_variant(value)
    zero = kind.rlike("^(BIGINT|DECIMAL|FLOAT|DOUBLE|BOOLEAN)") & (F.try_variant_get(value, "$", "double") == 0)
    return F.when(~F.coalesce(zero, F.lit(False)), text)


def resolve_player_id(df: DataFrame, field: str | None = None) -> Column:
    """The player id as text, or null.

    A named field is taken as it is. Otherwise the first field wins that is neither
    empty text nor the number zero; a zero in the last field still counts as an id.
    """
    types = dict(df.dtypes)
    if field is not None:
        return F.col(field).cast("string") if field in types else F.lit(None).cast("string")
    candidates = []
    for name in ID_FIELDS:
        if name not in types:
            continue
        text = F.col(name).cast("string")
        empty = text == ""
        if types[name] in _NUMERIC and name != ID_FIELDS[-1]:
            empty = empty | (F.col(name) == 0)
        candidates.append(F.when(~empty, text))
    return F.coalesce(*candidates) if candidates else F.lit(None).cast("string")


def has_player_id(player_id: Column) -> Column:
    return player_id.isNotNull() & (player_id != "")
