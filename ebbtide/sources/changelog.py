"""Change events: decode, encode, replay, and capture by comparing snapshots.

An event is a JSON envelope ``{before, after, op, ts_ms, source, seq}``: the full
row before and after the change, the operation (``c`` insert, ``r`` snapshot
read, ``u`` update, ``d`` delete), the commit time and its position in the log.

Events are ordered by ``source.lsn``, the position in the source's own log;
where it is missing, by the number that the transport gives its records, and
else by ``seq`` in the envelope. An event without any of these is a fault. All
events of one topic should carry the same kind of position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.signed import W
from ebbtide.specs import TableSpec

# Fixed values of the envelope format.
INSERT, READ, UPDATE, DELETE = "c", "r", "u", "d"
ADDS = (INSERT, READ, UPDATE)
REMOVES = (UPDATE, DELETE)
ENVELOPE = ("before", "after", "op", "ts_ms", "seq")


def envelope_schema(spec: TableSpec) -> T.StructType:
    return T.StructType(
        [
            T.StructField("before", spec.schema),
            T.StructField("after", spec.schema),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("seq", T.LongType()),
        ]
    )


def _read_schema(spec: TableSpec) -> T.StructType:
    source = T.StructField("source", T.StructType([T.StructField("lsn", T.LongType())]))
    return T.StructType([*envelope_schema(spec).fields, source])


def _position(event: Column, raw: DataFrame) -> Column:
    """Where in the log an event stands; ``raw`` may have the transport's number as ``seq``."""
    transport = [F.col("seq")] if "seq" in raw.columns else []
    return F.coalesce(event["source"]["lsn"], *transport, event["seq"])


def _fault(event: Column, position: Column) -> Column:
    """Why an envelope cannot be applied, or NULL if it can."""
    op = event["op"]
    return (
        F.when(event.isNull() | op.isNull(), F.lit("not a change event"))
        .when(~op.isin(INSERT, READ, UPDATE, DELETE), F.concat(F.lit("unknown operation "), op))
        .when(op.isin(*REMOVES) & event["before"].isNull(), F.lit("no before-image; the source must log full old rows"))
        .when(op.isin(*ADDS) & event["after"].isNull(), F.lit("no after-image"))
        .when(position.isNull(), F.lit("no position in the log: neither source.lsn nor a record number nor seq"))
    )


def decode(raw: DataFrame, spec: TableSpec, value: str = "value") -> DataFrame:
    """JSON text to envelopes, other columns passed through.

    A malformed value, an unknown operation, a missing row image or a missing
    position fails the query: dropping it would leave every view wrong without a trace.  Null
    values are tombstones and carry no change.
    """
    keep = [c for c in raw.columns if c not in (value, "seq")]
    event = F.from_json(F.col(value), _read_schema(spec), {"mode": "FAILFAST"})
    # Parsing inside a generator happens once per event: a filter on an event
    # field stays above it, instead of being pushed down with a parse of its own.
    parsed = raw.where(F.col(value).isNotNull()).select("*", F.explode(F.array(event)).alias("_event"))
    position = _position(F.col("_event"), raw)
    fault = _fault(F.col("_event"), position)
    checked = parsed.withColumn(
        "_event",
        F.when(fault.isNull(), F.col("_event")).otherwise(
            F.raise_error(F.concat(F.lit(f"{spec.name}: "), fault))
        ),
    )
    return checked.select(
        *keep, "_event.before", "_event.after", "_event.op", "_event.ts_ms", position.alias("seq")
    )


def judged(raw: DataFrame, spec: TableSpec, value: str = "value") -> DataFrame:
    """Raw events with a ``fault`` column, null for those that decode. Each is parsed once, as in ``decode``."""
    event = F.from_json(F.col(value), _read_schema(spec), {"mode": "PERMISSIVE"})
    parsed = raw.where(F.col(value).isNotNull()).select("*", F.explode(F.array(event)).alias("_event"))
    return parsed.withColumn("fault", _fault(F.col("_event"), _position(F.col("_event"), raw))).drop("_event")


def split_rejects(raw: DataFrame, spec: TableSpec, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(raw events that decode, rejected ones with a ``fault`` column)."""
    events = judged(raw, spec, value)
    return events.where(F.col("fault").isNull()).drop("fault"), events.where(F.col("fault").isNotNull())


def encode(events: DataFrame, spec: TableSpec, position: str = "seq") -> DataFrame:
    """Envelopes to JSON text in a column ``value``; the inverse of ``decode``.

    Every column is written, nulls too, and in the declared order. With
    ``position="lsn"`` the position is written as ``source.lsn``, as change
    capture on a database log does, and not as ``seq``.
    """
    if position not in ("seq", "lsn"):
        raise ValueError(f"position {position!r} is neither seq nor lsn")
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in envelope_schema(spec).fields]
    if position == "lsn":
        fields[-1] = F.struct(F.col("seq").cast("bigint").alias("lsn")).alias("source")
    typed = F.struct(*fields)
    keep = [c for c in events.columns if c not in ENVELOPE]
    return events.select(*keep, F.to_json(typed, {"ignoreNullFields": "false"}).alias("value"))


def signed(events: DataFrame) -> DataFrame:
    """Envelopes to signed rows: -1 for the row before, +1 for the row after."""
    op = F.col("op")
    images = F.array(
        F.struct(F.lit(-1).alias(W), F.when(op.isin(*REMOVES), F.col("before")).alias("row")),
        F.struct(F.lit(1).alias(W), F.when(op.isin(*ADDS), F.col("after")).alias("row")),
    )
    keep = [c for c in events.columns if c not in ENVELOPE] + ["ts_ms"]
    exploded = events.select(*keep, F.explode(images).alias("_image"))
    return exploded.where("_image.row IS NOT NULL").select("_image.row.*", *keep, f"_image.{W}")


def opening(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Signed rows that were there before the log began: the first before-image of each key, at +1.

    A log that starts in the middle, or that seeds a table by updates which
    change nothing, retracts rows it never inserted. Together with these rows
    ``signed`` is complete.
    """
    op = F.col("op")
    before = F.when(op.isin(*REMOVES), F.col("before"))
    first = events.groupBy(*_key(spec)).agg(F.min_by(before, "seq").alias("row"))
    return first.where("row IS NOT NULL").select("row.*", F.lit(1).alias(W))


def _key(spec: TableSpec) -> list[Column]:
    return [F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in spec.key]


def net_changes(events: DataFrame, spec: TableSpec, keep_unchanged: bool = False) -> DataFrame:
    """One row per key: the row before its first event and after its last one.

    Keys whose rows end up as they began are dropped, unless ``keep_unchanged``:
    who keeps state needs them, as they may be new to it.  ``min_by`` and
    ``max_by`` combine within each task, so a key with very many events crosses
    the shuffle once per task, and its rows without the key where it is theirs.
    """
    op = F.col("op")
    narrow = events.select(
        *_key(spec),
        F.when(op.isin(*REMOVES), _without_key(spec, "before")).alias("_before"),
        F.when(op.isin(*ADDS), _without_key(spec, "after")).alias("_after"),
        F.col("seq").alias("_seq"),
    )
    folded = narrow.groupBy(*spec.key).agg(
        F.min_by("_before", "_seq").alias("_before"), F.max_by("_after", "_seq").alias("_after")
    )
    net = folded.select(*spec.key, _with_key(spec, "_before").alias("before"), _with_key(spec, "_after").alias("after"))
    return net if keep_unchanged else changed(net)


def _without_key(spec: TableSpec, side: str) -> Column:
    """A row image for grouping by key: its values, and its own key only if that is not the key of its event."""
    own = F.struct(*[F.col(f"{side}.{k}").alias(k) for k in spec.key])
    event = F.struct(*_key(spec))
    values = [F.col(f"{side}.{c}").alias(f"_{c}") for c in spec.values]
    return F.when(F.col(side).isNotNull(), F.struct(*values, F.when(~own.eqNullSafe(event), own).alias("_own")))


def _with_key(spec: TableSpec, image: str) -> Column:
    """The row that ``_without_key`` took apart."""
    own = F.col(f"{image}._own")
    columns = [
        F.when(own.isNull(), F.col(c)).otherwise(own[c]).alias(c) if c in spec.key else F.col(f"{image}._{c}").alias(c)
        for c in spec.columns
    ]
    return F.when(F.col(image).isNotNull(), F.struct(*columns))


def changed(net: DataFrame) -> DataFrame:
    return net.where(~F.col("before").eqNullSafe(F.col("after")))


def against_stored(net: DataFrame, stored: DataFrame, spec: TableSpec) -> DataFrame:
    """Net changes with the row that is stored in place of the row before.

    A key that is not stored has no row before, so whatever its first event
    says it adds the row after and nothing else; ``unseen`` marks such keys if
    the event retracts a row other than the one after. ``stored`` is only met by
    the changed keys.
    """
    same = F.lit(True)
    for k in spec.key:
        same = same & stored[k].eqNullSafe(F.col(f"_n.{k}"))
    # Inner first, so that few changed keys can be broadcast against the state.
    matched = stored.join(net.select(*spec.key).alias("_n"), same).select(
        *[stored[k].alias(f"_s_{k}") for k in spec.key], F.struct(*[stored[c].alias(c) for c in spec.columns]).alias("_stored")
    )
    at = F.lit(True)
    for k in spec.key:
        at = at & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    lost = F.col("_stored").isNull() & F.col("before").isNotNull() & ~F.col("before").eqNullSafe(F.col("after"))
    return net.join(matched, at, "left").select(
        *spec.key, F.col("_stored").alias("before"), "after", lost.alias("unseen")
    )


def signed_changes(net: DataFrame) -> DataFrame:
    """Net changes to signed rows."""
    images = F.array(
        F.struct(F.lit(-1).alias(W), F.col("before").alias("row")),
        F.struct(F.lit(1).alias(W), F.col("after").alias("row")),
    )
    return net.select(F.explode(images).alias("_i")).where("_i.row IS NOT NULL").select("_i.row.*", f"_i.{W}")


def replay(events: DataFrame, spec: TableSpec) -> DataFrame:
    """The table that a change log leads to: the last event per key wins."""
    last = events.groupBy(*_key(spec)).agg(F.max_by(F.struct("op", "after"), "seq").alias("_last"))
    return last.where(F.col("_last.op") != DELETE).select("_last.after.*")


def replay_by_key(events: DataFrame, spec: TableSpec) -> DataFrame:
    """``replay`` whose rows stay where they were grouped, so that what compares them by key needs no exchange of its own.

    The key is sent once, and not in the row again. A last event whose row has
    lost the key of the row before fails the query: its row belongs elsewhere.
    """
    lost = F.lit(False)
    for k in spec.key:
        lost = lost | (F.col(f"after.{k}").isNull() & F.col(f"before.{k}").isNotNull())
    there = F.col("op") != DELETE
    state = F.struct(there.alias("there"), lost.alias("lost"), *[F.col(f"after.{c}").alias(f"_{c}") for c in spec.values])
    # Narrow rows first: grouping within a task sorts what it is given.
    narrow = events.select(*_key(spec), state.alias("_state"), F.col("seq").alias("_seq"))
    found = narrow.groupBy(*spec.key).agg(F.max_by("_state", "_seq").alias("_last")).where("_last.there")
    fault = F.raise_error(F.lit(f"{spec.name}: a row has lost the key of the row before")).cast("boolean")
    found = found.where(F.when(F.col("_last.lost"), fault).otherwise(F.lit(True)))
    return found.select(*[c if c in spec.key else F.col(f"_last._{c}").alias(c) for c in spec.columns])


def _row(spec: TableSpec, side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in spec.columns])


def snapshot_events(df: DataFrame, spec: TableSpec, ts_ms: Column | int, seq: Column | int = 0) -> DataFrame:
    """Publish every row of a table as an ``r`` event, to seed a topic."""
    rows = spec.conform(df).select(F.struct(*spec.columns).alias("after"))
    return rows.select(
        F.lit(None).cast(spec.schema).alias("before"),
        "after",
        F.lit(READ).alias("op"),
        _long(ts_ms).alias("ts_ms"),
        _long(seq).alias("seq"),
    )


def diff(old: DataFrame, new: DataFrame, spec: TableSpec, ts_ms: Column | int, seq: Column | int = 0) -> DataFrame:
    """The change events that turn snapshot ``old`` into snapshot ``new``.

    Rows are matched on the key and compared null-safely; rows that are the
    same on both sides produce nothing.
    """
    a = spec.conform(old).select(*spec.key, F.struct(*spec.columns).alias("before"))
    b = spec.conform(new).select(*spec.key, F.struct(*spec.columns).alias("after"))
    both = a.join(b, list(spec.key), "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
    op = (
        F.when(F.col("before").isNull(), INSERT).when(F.col("after").isNull(), DELETE).otherwise(UPDATE)
    )
    return both.select(
        "before", "after", op.alias("op"), _long(ts_ms).alias("ts_ms"), _long(seq).alias("seq")
    )


def _long(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("bigint")
