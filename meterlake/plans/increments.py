"""The warehouse by deliveries: write, audit, publish.

A delivery of readings is read once. Its meter x hour totals become a new part
of the totals, its dimension rows are merged into the published dimensions, and
the fact gets a new part with the hours that it lacks. All of it goes to new
folders. Then the delivery's checks are added to the stored results of the
earlier ones, and only if the gate lets the run pass does a new state of the
manifest make everything visible, at once. A failing gate, or a run that dies
anywhere, leaves the published tables as they were, and the same delivery can
be given again; a delivery that was published before is not counted twice.

What a run reads does not grow with the history: the delivery, the dimensions,
the totals of the dates beyond the high-water mark (or, with late="merge", of
the dates that the delivery touches), the stored check results, and 64 bits per
key of the fact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import files
from meterlake.functions.numbering import gapless, with_local_number
from meterlake.operators import check_state, marts, quality, readings
from meterlake.plans.materialize import FACT_PARTITION, high_water_mark, merge_by_key, typed_literal, with_partition
from meterlake.schemas import FACT_COLUMNS
from meterlake.sinks import dated
from meterlake.sinks.manifest import Manifest

FACT, METERS, ZONES, DATES = "fct_energy_consumption", "dim_meters", "dim_grid_zones", "dim_dates"
FACT_KEY = quality.Check(FACT, "consumption_id", "unique")
KEY_SCHEMA = T.StructType([T.StructField("h", T.LongType()), T.StructField(FACT_PARTITION, T.DateType())])
KINDS = ["hours", "fact", "keys", "dims", "checks", "scratch"]


class DuplicateKeys(ValueError):
    """The updates of an upsert hold a row of the fact's grain more than once."""


@dataclass
class Run:
    mode: str  # "full", "incremental", "skipped", "merged" or "repeated" (this delivery was published before)
    high_water_mark: str | None  # before the run
    published: bool
    state_number: int
    checks: DataFrame | None
    tables: dict[str, DataFrame] = field(default_factory=dict)


class Warehouse:
    """The marts below ``base``, as the current state of its manifest has them."""

    def __init__(self, spark: SparkSession, base: str, late: str = "ignore", fan_in: int = dated.FAN_IN):
        if late not in ("ignore", "merge"):
            raise ValueError(f"unknown rule for late hours {late!r}")
        self.spark, self.late, self.fan_in = spark, late, fan_in
        self.manifest = Manifest(spark, base)

    # --- reading -----------------------------------------------------------------------

    def tables(self, state: dict | None = None) -> dict[str, DataFrame]:
        """The four marts of a state (the current one)."""
        state = self.manifest.current()[1] if state is None else state
        if not state:
            raise ValueError(f"{self.manifest.base}: nothing was published yet")
        dims = self.manifest.at(state["dims"])
        meters = self._read(f"{dims}/meters", state, "meters")
        return {
            FACT: self._fact(state, state["fact"]).select(*FACT_COLUMNS),
            METERS: meters.drop("meter_number"),
            ZONES: marts.dim_grid_zones_from_bitmaps(self._read(f"{dims}/zones", state, "zones")),
            DATES: self._read(f"{dims}/dates", state, "dates"),
        }

    def stored_checks(self, state: dict | None = None) -> DataFrame:
        """The 20 checks of a state (the current one), from the results stored by part."""
        state = self.manifest.current()[1] if state is None else state
        results = self.spark.read.schema(check_state.STATE_SCHEMA).parquet(self.manifest.at(state["checks"]))
        return check_state.evaluate_state(results, quality.SOURCE_SUITE + quality.MART_SUITE)

    def register(self) -> dict[str, DataFrame]:
        """The marts as views under their names; run it again to see a newer state."""
        found = self.tables()
        for name, df in found.items():
            df.createOrReplaceTempView(name)
        return found

    def hours(self, state: dict | None = None, entries: list[dict] | None = None) -> DataFrame:
        """Mergeable meter x hour totals of all deliveries."""
        state = self.manifest.current()[1] if state is None else state
        entries = state["hours"] if entries is None else entries
        return dated.read_parts(self.manifest, entries, self._schema(state, "hours"), FACT_PARTITION)

    def _fact(self, state: dict, entries: list[dict]) -> DataFrame:
        return dated.read_parts(self.manifest, entries, self._schema(state, "fact"), FACT_PARTITION)

    def _schema(self, state: dict, table: str) -> T.StructType:
        return T.StructType.fromJson(state["schemas"][table])

    def _read(self, path: str, state: dict, table: str) -> DataFrame:
        return self.spark.read.schema(self._schema(state, table)).parquet(path)

    # --- one run -----------------------------------------------------------------------

    def apply(self, source: DataFrame, delivery: str | None = None, full_refresh: bool = False, gate: bool = True,
              warn: Iterable[quality.Check] = ()) -> Run:
        """Build from a delivery of readings, check, and publish if the gate passes.

        Without ``delivery`` the source is the whole history: totals and
        dimensions are built anew, the fact is still extended by the hours after
        its newest one (or built anew with ``full_refresh``). ``gate=False``
        publishes whatever the checks say, and a failing check in ``warn`` is
        reported but stops nothing. Raises ``DataQualityError`` where the gate
        fails."""
        number, state = self.manifest.current()
        if delivery is not None and delivery in state.get("deliveries", []):
            return Run("repeated", state["mark"], False, number, None, self.tables(state))
        draft, mode = self._draft(source, state, delivery, full_refresh)
        result = quality.evaluated(self.stored_checks(draft))
        if gate:
            quality.gate(result, warn)
        number = self.manifest.commit(number, draft)
        return Run(mode, state.get("mark"), True, number, result, self.tables(draft))

    def _draft(self, source: DataFrame, state: dict, delivery: str | None, full_refresh: bool) -> tuple[dict, str]:
        """Write what the run adds; the state that would publish it, and how the fact grew."""
        staged = readings.staging(source)
        totals = dated.with_date(marts.meter_hour_parts(staged), "consumption_hour", FACT_PARTITION)
        whole = delivery is None
        draft: dict = {
            "deliveries": [] if whole else [*state.get("deliveries", []), delivery],
            "schemas": dict(state["schemas"]) if state and not whole else {"hours": totals.schema.jsonValue()},
            "mark": state.get("mark"),
        }
        part = dated.write_part(self.manifest, "hours", totals, FACT_PARTITION)
        new = [part] if part else []
        draft["hours"] = new if whole else [*state.get("hours", []), *new]
        mine = self.hours(draft, new)
        with ThreadPoolExecutor(max_workers=2) as pool:  # independent Spark jobs
            dimensions = pool.submit(self._write_dimensions, draft, {} if whole else state, mine)
            fact = pool.submit(self._extend_fact, draft, state, new, full_refresh)
            dimensions.result()
            mode, added = fact.result()
        self._write_checks(draft, {} if whole else state, source, delivery or "all", added, mode)
        return draft, mode

    # --- dimensions ----------------------------------------------------------------------

    def _write_dimensions(self, draft: dict, state: dict, mine: DataFrame) -> None:
        """Dimensions of the state and of the new totals (``mine``), merged, in a new folder."""
        folder = self.manifest.fresh("dims")
        at = self.manifest.at(folder)
        old = self.manifest.at(state["dims"]) if state else None
        incoming = marts.dim_meters_from_meter_hours(mine)

        fresh = incoming.select("meter_id")
        if old:
            known = self._read(f"{old}/meters", state, "meters")
            fresh = fresh.join(known.select("meter_id"), "meter_id", "left_anti")
        scratch = self.manifest.at(self.manifest.fresh("scratch"))
        with_local_number(fresh).write.parquet(scratch)
        fresh = self.spark.read.schema("meter_id string, local_number bigint").parquet(scratch)
        n_known = state.get("meters", 0)
        numbers = gapless(fresh, n_known + 1, name="meter_number")
        merged = incoming.join(numbers, "meter_id", "left")
        if old:
            merged = marts.merged_dim_meters(merged.unionByName(known))
        merged.write.parquet(f"{at}/meters")
        draft["meters"] = n_known + fresh.count()
        draft["schemas"]["meters"] = merged.schema.jsonValue()

        meters = self.spark.read.schema(merged.schema).parquet(f"{at}/meters").select("meter_id", "meter_number")
        pairs = mine.select("grid_zone", "meter_id").distinct().join(meters, "meter_id")
        dates = marts.dim_dates_from_meter_hours(mine)
        bitmaps = marts.zone_bitmaps(pairs)
        if old:
            bitmaps = marts.merged_zone_bitmaps(bitmaps.unionByName(self._read(f"{old}/zones", state, "zones")))
            dates = dates.unionByName(self._read(f"{old}/dates", state, "dates")).distinct()
        bitmaps.write.parquet(f"{at}/zones")
        dates.write.parquet(f"{at}/dates")
        draft["schemas"] |= {"zones": bitmaps.schema.jsonValue(), "dates": dates.schema.jsonValue()}
        draft["dims"] = folder

    # --- fact ----------------------------------------------------------------------------

    def _fact_rows(self, totals: DataFrame) -> DataFrame:
        return with_partition(marts.fact_consumption(marts.hourly_from_meter_hours(marts.merged_meter_hours(totals))))

    def _extend_fact(self, draft: dict, state: dict, new: list[dict], full_refresh: bool) -> tuple[str, list[dict]]:
        """Set the draft's fact; how it was extended, and the parts that were added."""
        totals = self.hours(draft)
        draft["schemas"]["fact"] = self._fact_rows(totals).schema.jsonValue()
        old = [] if full_refresh else state.get("fact", [])
        if "fact" not in state or full_refresh:
            mode = "full"
        elif self.late == "merge":
            mode, touched = "merged", [d for e in new for d in e["dates"]]
            totals = self.hours(draft, [{**e, "dates": d, "all": False} for e in draft["hours"] if (d := [x for x in e["dates"] if x in touched])])
        elif state["mark"] is None:
            draft["fact"] = old
            return "skipped", []
        else:
            mode = "incremental"
            mark = typed_literal(state["mark"], totals, "consumption_hour")
            totals = totals.where((F.col(FACT_PARTITION) >= F.to_date(mark)) & (F.col("consumption_hour") > mark))
        part = dated.write_part(self.manifest, "fact", self._fact_rows(totals), FACT_PARTITION)
        added = [part] if part else []
        draft["fact"] = dated.replaced(old, part) if part and mode == "merged" else [*old, *added]
        if added:
            newest = high_water_mark(self._fact(draft, added))
            draft["mark"] = max(filter(None, [newest, None if mode == "full" else state.get("mark")]), default=None)
        elif mode == "full":
            draft["mark"] = None
        return mode, added

    # --- checks --------------------------------------------------------------------------

    def _write_checks(self, draft: dict, state: dict, source: DataFrame, delivery: str, added: list[dict], mode: str) -> None:
        """Write the results by part: the stored ones that still hold, and the new."""
        suite = lambda model: [c for c in quality.SOURCE_SUITE + quality.MART_SUITE if c.model == model]
        new = check_state.part_state(source, suite("meter_readings"), delivery)
        tables = self.tables(draft)
        for name in (METERS, ZONES, DATES):
            new = new.unionByName(check_state.part_state(tables[name], suite(name), "all"))
        # A whole build has no stored results: the fact is checked from end to end.
        fact, date = self._fact(draft, added if state else draft["fact"]), F.col(FACT_PARTITION).cast("string")
        by_date = [c for c in suite(FACT) if state or c.kind != "unique"]
        new = new.unionByName(check_state.part_state(fact, by_date, date))
        if not state:
            new = new.unionByName(check_state.part_state(fact, [FACT_KEY], check_state.ACROSS))

        across = None
        if state:
            stored = self.spark.read.schema(check_state.STATE_SCHEMA).parquet(self.manifest.at(state["checks"]))
            stored = stored.where(~F.col("model").isin(METERS, ZONES, DATES))
            mine = F.col("model") == FACT
            if mode == "full":
                stored = stored.where(~mine)
            elif mode == "merged" and added:  # the dates of keys in several parts may have been replaced
                across = stored.where(mine & (F.col("part") == check_state.ACROSS)).select(F.xxhash64("value").alias("h"))
                gone = [d for e in added for d in e["dates"]]
                stored = stored.where(~(mine & F.coalesce(F.col("part"), F.lit(dated.NO_DATE)).isin(check_state.ACROSS, *gone)))
            new = new.unionByName(stored)
        draft["checks"] = self.manifest.fresh("checks")
        at = self.manifest.at(draft["checks"])
        if not state:
            new.write.parquet(at)  # the first delivery after it writes the key hashes
            return
        with ThreadPoolExecutor(max_workers=2) as pool:
            written = pool.submit(new.write.parquet, at)
            met = pool.submit(self._keys_met, draft, state, added, mode, across).result()
            written.result()
        if met is not None:
            check_state.repeated_across(FACT_KEY, met, self._fact(draft, draft["fact"])).write.mode("append").parquet(at)

    def _keys_met(self, draft: dict, state: dict, added: list[dict], mode: str, across: DataFrame | None) -> DataFrame | None:
        """Write the key hashes of the fact's new parts; those that other parts hold
        as well (or None), and those of the stored ``across`` to be counted again."""
        keys = [] if mode == "full" else state.get("keys", [])
        unseen = added if "keys" in state else draft["fact"]
        hashes = check_state.key_hashes(self._fact(draft, unseen), FACT_KEY.column, FACT_PARTITION)
        part = dated.write_part(self.manifest, "keys", hashes, FACT_PARTITION)
        if part and mode == "merged":
            keys = dated.replaced(keys, part)[:-1]
        draft["keys"] = [*keys, *([part] if part else [])]
        if not part:
            return None
        read = lambda entries: dated.read_parts(self.manifest, entries, KEY_SCHEMA, FACT_PARTITION)
        met = check_state.met_hashes(read([part]), read(keys) if keys else None)
        met = met if across is None else met.union(across).distinct()
        return met if met.limit(1).count() else None

    # --- maintenance ---------------------------------------------------------------------

    def upsert(self, updates: DataFrame, key: str = "consumption_id") -> int:
        """Upsert fact rows by key; the number of the state that shows them.

        All rows of a key are replaced by all updates of that key: a meter that
        changes zone (or type) inside an hour has several rows with one key.
        The touched dates are merged into a new part, which takes them over when
        the state is committed: a run that dies between leaves the old fact.
        Raises ``DuplicateKeys`` if the updates hold a key twice for the same
        zone and type."""
        number, state = self.manifest.current()
        updates = with_partition(updates.select(*FACT_COLUMNS))
        twice = updates.groupBy(key, "grid_zone", "meter_type").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key).distinct()
        some = twice.orderBy(key).limit(5).collect()
        if some:
            raise DuplicateKeys(f"{twice.count()} key(s) occur more than once, such as {', '.join(str(r[0]) for r in some)}")
        touched = [r[0] or dated.NO_DATE for r in updates.select(F.col(FACT_PARTITION).cast("string")).distinct().collect()]
        entries = [{**e, "dates": d, "all": False} for e in state["fact"] if (d := [x for x in e["dates"] if x in touched])]
        merged = merge_by_key(self._fact(state, entries), updates, key)
        part = dated.write_part(self.manifest, "fact", merged, FACT_PARTITION)
        if part is None:
            return number
        return self.manifest.commit(number, {**state, "fact": dated.replaced(state["fact"], part)})

    def compact(self) -> int:
        """Merge the full size tiers of totals, fact and keys; the new state's number."""
        number, state = self.manifest.current()
        merges: dict[str, Callable[[DataFrame], DataFrame]] = {
            "hours": lambda df: dated.with_date(marts.merged_parts(df), "consumption_hour", FACT_PARTITION),
            "fact": lambda df: df, "keys": lambda df: df,
        }
        schemas = {"hours": self._schema(state, "hours"), "fact": self._schema(state, "fact"), "keys": KEY_SCHEMA}
        draft = {**state}
        for kind, merge in merges.items():
            if kind not in state:
                continue
            draft[kind] = dated.merge_parts(self.manifest, kind, state[kind], schemas[kind], FACT_PARTITION, merge, self.fan_in)
        return number if draft == state else self.manifest.commit(number, draft)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what none of the last ``keep`` states shows (failed runs' folders
        as well). Not for use while a run is under way."""
        live = []
        for n in self.manifest.numbers()[-keep:]:
            state = self.manifest.state(n)
            live += [e["folder"] for kind in ("hours", "fact", "keys") for e in state.get(kind, [])] + [state["dims"], state["checks"]]
        return self.manifest.vacuum(live, KINDS, keep)

    def size_of(self, state: dict, kind: str) -> int:
        return sum(files.size_of(self.spark, self.manifest.at(e["folder"])) for e in state[kind])


