"""Explicit schemas of the files this package reads; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _D, _V = T.LongType(), T.StringType(), T.DoubleType(), T.VariantType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One row per play: whole seconds since the epoch.
SCORE_CSV = _struct(device=_L, score=_L, time=_L)

# One line per player. A score may be any JSON value, so it stays a variant.
SCORE_LOG = _struct(
    device_id=_S,
    uid=_S,
    player_id=_S,
    records=T.ArrayType(_struct(time=_D, score=_V, event=_S)),
)

RACE_EVENT = _struct(
    time=_D,
    date=_S,
    clientIp=_S,
    app=_S,
    appVersion=_S,
    device=_S,
    event=_S,
    platform=_S,
    properties=_V,
    uid=_S,
    calcDate=_S,
    localTime=_S,
    queueDuration=_S,
)
RACE_LOG = _struct(device_id=_S, uid=_S, player_id=_S, records=T.ArrayType(RACE_EVENT))

# Values of the two keyed documents: one match, and the players of one match.
MATCH = _struct(
    server=_S,
    port=_L,
    official=T.BooleanType(),
    group=_S,
    date=_L,
    timeLimit=_L,
    duration=_L,
    mapId=_L,
    teams=T.ArrayType(_struct(name=_S, score=_L, splats=_S)),
)
MATCH_PLAYERS = T.ArrayType(
    _struct(
        auth=T.BooleanType(),
        name=_S,
        flair=_L,
        degree=_L,
        score=_L,
        points=_L,
        team=_L,
        events=_S,
    )
)

# Canonical event row, the one contract between the sources and the operators.
EVENT = _struct(
    player_id=_S,
    ts=T.TimestampType(),
    pos=_L,
    event=_S,
    is_play=T.BooleanType(),
    score=_D,
    is_purchase=T.BooleanType(),
    price=_D,
)
EVENT_COLUMNS = tuple(EVENT.names)
