"""All four result views from one change stream, as one job.

Each micro-batch is folded to one net change per key and joined with the keyed
state of the other tables:

    changes of A  x  B as it was   +   A as it is  x  changes of B

What changes in lines x products is worked out once and feeds categories,
anomalies and enriched rows. Line events are parsed a second time for the
windows, which need each change and not the net one.

State holds at most one row per key, so retractions of rows that have expired,
or that were never seen, cannot multiply into phantom rows.  Source state and
results are segment tables: running a batch again rewrites the same segments
from the same inputs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cache, reduce
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbtide import specs
from ebbtide.operators import signed as S
from ebbtide.plans import views
from ebbtide.session import shuffles_removed
from ebbtide.sinks.keyed import SumTable, UpsertTable, keyed_changes
from ebbtide.sources import changelog, topics
from ebbtide.specs import TableSpec
from ebbtide.streaming.parallel import adaptive, together


# The columns on which each table meets the others.
JOIN_COLUMNS = {"lines": ("order_id", "goods_id"), "orders": ("order_id",), "products": ("goods_id",)}

# What a micro-batch reads again is kept as far as memory goes; the rest is read from its source once more, and takes no disk.
CACHED = StorageLevel.MEMORY_ONLY


class Target(Protocol):
    """A further place for a result, such as ``sinks.jdbc.JdbcUpsert``.

    ``changes`` has one row for each key that a micro-batch touched, as the
    result holds it now, or with ``_deleted`` true. A batch that runs again
    writes the same rows again.
    """

    def write(self, changes: DataFrame, spec: TableSpec) -> None: ...


@dataclass
class Settings:
    """``ttl`` gives the idle time after which source rows leave the join state, as an
    interval string per table, for example ``{"order_goods": "1 hour"}``.  The
    catalog is seeded once and should not expire; running totals never do.

    ``window_on`` is ``proc_time`` (when the change was read) or ``event_time``
    (its commit time).

    ``topics`` names the topic of a table where it is not the table's own name,
    for example ``{"order_goods": "shop.public.order_goods"}``. A record of any
    other topic stops the job before anything of its batch is written.

    ``targets`` gives results, by name, a second place to be written to. Running
    totals arrive there as totals and not as their changes.
    """

    window: str = "10 seconds"
    window_on: str = "proc_time"
    ttl: Mapping[str, str] = field(default_factory=dict)
    topics: Mapping[str, str] = field(default_factory=dict)
    targets: Mapping[str, Target] = field(default_factory=dict)
    fan_in: int = 8
    line_items: TableSpec = specs.ORDER_GOODS
    orders: TableSpec = specs.ORDER_INFO
    products: TableSpec = specs.GOODS_INFO


class StatementSet:
    def __init__(self, spark: SparkSession, root: str, settings: Settings | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings or Settings()
        s = self.settings
        ids = {f.name: f.dataType.simpleString() for f in s.line_items.schema.fields}
        keyed = {"rec_id": ids["rec_id"], "order_id": ids["order_id"]}
        enriched = specs.ENRICHED_LINE_ITEMS.retyped(**keyed)
        anomalies = specs.PRICING_ANOMALIES.retyped(**keyed)
        self.state = {
            "lines": self._state(s.line_items, "order_id"),
            "orders": self._state(s.orders, "order_id"),
            "products": self._state(s.products, "goods_id"),
        }
        self.enriched = UpsertTable(spark, self._at("enriched_line_items"), enriched, "seen_at")
        self.anomalies = UpsertTable(spark, self._at("pricing_anomalies"), anomalies, "detected_at")
        self.categories = SumTable(
            spark, self._at("revenue_by_category"), specs.CATEGORY_TOTALS, "line_items"
        )
        self.windows = SumTable(
            spark, self._at("revenue_by_window"), specs.WINDOW_TOTALS, "line_items", False
        )
        self.unmatched = SumTable(spark, self._at(specs.UNMATCHED.name), specs.UNMATCHED, "retractions")

        names = {t.spec.name for t in self.state.values()}
        if strange := set(s.topics) - names:
            raise ValueError(f"topics are given for {sorted(strange)}, which are none of {sorted(names)}")
        self.topic_of = {n: s.topics.get(t.spec.name, t.spec.name) for n, t in self.state.items()}

    def _at(self, name: str) -> str:
        return f"{self.root}/results/{name}"

    def _state(self, spec: TableSpec, sort_by: str) -> UpsertTable:
        return UpsertTable(self.spark, f"{self.root}/state/{spec.name}", spec, sort_by=sort_by)

    @property
    def tables(self) -> list:
        return [*self.state.values(), self.enriched, self.anomalies, self.categories, self.windows, self.unmatched]

    def create_if_absent(self) -> None:
        for table in self.tables:
            table.create_if_absent()

    # -- reading
    def read(self, name: str) -> DataFrame:
        """One of the four result tables as it is now, or ``unmatched_retractions``.

        The latter counts what was taken back of tables without a ``ttl`` but was
        never there; with a ``ttl`` such rows cannot be told from expired ones.
        """
        if name == "enriched_line_items":
            return self.enriched.read()
        if name == "pricing_anomalies":
            return self.anomalies.read()
        if name == "revenue_by_category":
            return views.published(self.categories.read())
        if name == "revenue_by_window":
            return views.published(self.windows.read())
        if name == specs.UNMATCHED.name:
            return self.unmatched.read()
        raise KeyError(name)

    # -- running
    def start(
        self, changes: DataFrame, checkpoint: str | None = None, every: str | None = "30 seconds", drain: bool = False
    ) -> StreamingQuery:
        """Run over a stream of ``topic, value[, seq]``.

        ``every`` is the checkpoint interval: progress is committed with each
        micro-batch.  ``drain`` processes what is there and stops.
        """
        self.create_if_absent()
        stamped = topics.with_processing_time(changes)
        writer = stamped.writeStream.foreachBatch(self.apply).option(
            "checkpointLocation", checkpoint or f"{self.root}/checkpoint"
        )
        writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)
        return writer.queryName(f"statement-set-{self.root.rsplit('/', 1)[-1]}").start()

    def apply(self, batch: DataFrame, number: int) -> None:
        """Apply micro-batch ``number`` of ``topic, value, proc_time[, seq]`` to all tables."""
        with adaptive(batch), shuffles_removed(batch.sparkSession):
            self._apply_cached(batch.persist(CACHED), number)

    def _apply_cached(self, batch: DataFrame, number: int) -> None:
        try:
            present = {r["topic"]: r for r in batch.groupBy("topic").agg(F.max("proc_time").alias("at")).collect()}
            if present:
                self._apply(batch, number, {t: r["at"] for t, r in present.items()})
        finally:
            batch.unpersist()

    def _apply(self, batch: DataFrame, number: int, topics_at: dict) -> None:
        if strange := set(topics_at) - set(self.topic_of.values()):
            raise ValueError(f"records of unknown topics {sorted(map(str, strange))}; name them in Settings.topics")
        before = number - 1
        at = F.lit(max(topics_at.values()))
        results = (self.enriched, self.anomalies, self.categories, self.windows, self.unmatched)
        fan_in = self.settings.fan_in
        together(
            self.spark,
            *[lambda n=n: self.state[n].compact(before, fan_in, newer_than=self._deadline(n, at)) for n in self.state],
            *[lambda t=t: t.compact(before, fan_in) for t in results],
        )

        events = {
            name: topics.decode_topic(batch, table.spec, self.topic_of[name])
            for name, table in self.state.items()
            if self.topic_of[name] in topics_at
        }
        nets = {n: self._net(n, e, before, at).persist(CACHED) for n, e in events.items()}
        try:
            # This fills the caches, which makes their real sizes known: these
            # decide whether changes are broadcast against the state.  Lost
            # blocks are computed again.
            found = together(self.spark, *[lambda n=n: _key_ranges(nets[n], JOIN_COLUMNS[n]) for n in nets])
            ranges = dict(zip(nets, found))
            # State is read by batch number, so writing the new state first
            # leaves the old one readable.
            together(self.spark, *[lambda n=n: self._write_state(n, number, nets[n], at) for n in nets])
            self._write_results(number, events, nets, ranges, at)
            lost = [(self.state[n].spec.name, r["unseen"]) for n, r in ranges.items() if r["unseen"]]
            if lost:
                self.unmatched.write(number, self.spark.createDataFrame(lost, "table_name STRING, retractions BIGINT"))
        finally:
            for net in nets.values():
                net.unpersist()

    def _write_state(self, name: str, number: int, net: DataFrame, at: Column) -> None:
        table = self.state[name]
        table.write(number, _as_upserts(net, table.spec), at)

    def _net(self, name: str, events: DataFrame, before: int, at: Column) -> DataFrame:
        """One row per key that has events, also if they change nothing: they may seed the key, and keep it from expiring.

        Without a ``ttl`` the stored row is what the results know of a key. With
        one it may have expired, and then the event's own before-image says what
        to take back.
        """
        table = self.state[name]
        net = changelog.net_changes(events, table.spec, keep_unchanged=True)
        if self._deadline(name, at) is not None:
            return net.withColumn("unseen", F.lit(False))
        return changelog.against_stored(net, table.read(before), table.spec)

    def _write_results(self, number: int, events: dict, nets: dict, ranges: dict, at: Column) -> None:
        # Only the state that the changes of this batch meet is read at all.
        old = cache(lambda name: self._read_state(name, number - 1, at))
        new = cache(lambda name: self._read_state(name, number, at))
        delta = {name: changelog.signed_changes(changelog.changed(net)) for name, net in nets.items()}
        jobs, sold = [], _sold_changes(delta, old, new, ranges)
        if sold is not None:
            sold = sold.persist(CACHED)
            sums = views.category_sums(sold)
            jobs.append(lambda: self._add(self.categories, number, self.categories.fold(sums)))
            found = keyed_changes(views.anomalies_among(sold), self.anomalies.spec)
            jobs.append(lambda: self._upsert(self.anomalies, number, found, at))
        parts = _enriched_changes(sold, delta, old, new, ranges)
        if parts:
            rows = S.union(*parts)
            jobs.append(lambda: self._upsert(self.enriched, number, keyed_changes(rows, self.enriched.spec), at))
        if "lines" in events:
            lines = changelog.signed(events["lines"])
            by_read = self.settings.window_on == "proc_time"
            time = F.col("proc_time") if by_read else F.timestamp_millis("ts_ms")
            windows = views.window_deltas(lines, time, self.settings.window)
            jobs.append(lambda: self._add(self.windows, number, windows))
        try:
            together(self.spark, *jobs)
        finally:
            if sold is not None:
                sold.unpersist()

    def _upsert(self, table: UpsertTable, number: int, changes: DataFrame, at: Column) -> None:
        table.write(number, changes, at)
        if target := self.settings.targets.get(table.spec.name):
            target.write(changes, table.spec)

    def _add(self, table: SumTable, number: int, deltas: DataFrame) -> None:
        table.write(number, deltas)
        if target := self.settings.targets.get(table.spec.name):
            totals = views.published(table.read(number))
            spec = TableSpec(table.spec.name, totals.schema, table.spec.key)
            touched = table.batch(number).select(*[F.col(k).alias(f"_t_{k}") for k in spec.key]).distinct()
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in spec.key])
            rows = touched.join(totals.withColumn("_there", F.lit(True)), same, "left").select(
                *[F.col(f"_t_{k}").alias(k) for k in spec.key], *spec.values, F.col("_there").isNull().alias("_deleted")
            )
            target.write(rows.select(*spec.columns, "_deleted"), spec)

    # -- expiry
    def _deadline(self, name: str, at: Column) -> Column | None:
        idle = self.settings.ttl.get(self.state[name].spec.name)
        return None if idle is None else at - F.expr(f"INTERVAL {idle}")

    def _read_state(self, name: str, as_of: int, at: Column) -> DataFrame:
        return self.state[name].read(as_of, self._deadline(name, at))


def _as_upserts(net: DataFrame, spec: TableSpec) -> DataFrame:
    columns = [F.col(k) if k in spec.key else F.col(f"after.{k}").alias(k) for k in spec.columns]
    return net.select(*columns, F.col("after").isNull().alias("_deleted"))


def _key_ranges(net: DataFrame, columns: tuple[str, ...]) -> dict:
    """The lowest and highest value of each join column among the changes, and how many are ``unseen``."""
    ends = net.agg(
        F.count(F.when(F.col("unseen"), 1)).alias("unseen"),
        *[F.min(F.least(f"before.{c}", f"after.{c}")).alias(f"low_{c}") for c in columns],
        *[F.max(F.greatest(f"before.{c}", f"after.{c}")).alias(f"high_{c}") for c in columns],
    ).first()
    return {"unseen": ends["unseen"], **{c: (ends[f"low_{c}"], ends[f"high_{c}"]) for c in columns}}


def _within(state: DataFrame, column: str, changes: dict[str, tuple]) -> DataFrame:
    """State that can match the changes at all.

    State files are sorted by their join column and ids mostly grow with time,
    so this range lets the scan skip the row groups of old orders.
    """
    low, high = changes[column]
    return state.where(F.col(column).between(low, high)) if low is not None else state.where(F.lit(False))


def _sold_changes(delta: dict, old: Callable, new: Callable, ranges: dict) -> DataFrame | None:
    """What changes in lines x products.

    Tables without changes in this batch add nothing, so the state of the lines
    is only scanned when an order or a product did change.
    """
    parts = []
    if "lines" in delta:
        parts.append(views.sold_products(delta["lines"], _within(old("products"), "goods_id", ranges["lines"])))
    if "products" in delta:
        parts.append(views.sold_products(_within(new("lines"), "goods_id", ranges["products"]), delta["products"]))
    return S.union(*parts) if parts else None


def _enriched_changes(sold: DataFrame | None, delta: dict, old: Callable, new: Callable, ranges: dict) -> list[DataFrame]:
    """What changes in (lines x products) x orders."""
    parts = []
    if sold is not None:
        # Lines of changed products may belong to any order.
        orders = old("orders") if "products" in delta else _within(old("orders"), "order_id", ranges["lines"])
        parts.append(views.with_orders(sold, orders))
    if "orders" in delta:
        lines = _within(new("lines"), "order_id", ranges["orders"])
        parts.append(views.enriched(lines, delta["orders"], new("products")))
    return parts
