"""The three runs of the telemetry workflow, composed from the operators.

``ingest``  batch files -> contract -> typed rows -> Parquet under the processing
            date and the poll's batch id; what is broken aborts the run or is
            quarantined, and counts in and out must agree
``load``    one processing date (or one batch of it) -> bronze table, under the
            load's id (dense surrogate ids, one insert timestamp per load), and an
            entry in the ledger of loads
``build``   the loads not built yet -> silver and fact (upserts into snapshot
            tables, rows without a key quarantined) -> dimensions (merged with what
            is stored) -> the declared data-quality suite over the state kept by
            partition, written as a verdict table

Every run may be repeated after a failure: it replaces what it wrote before.

usage: python -m aerolake.jobs ingest <input> <parquet_root> <yyyy-mm-dd> [<batch id>]
       python -m aerolake.jobs load <parquet_root> <yyyy-mm-dd> <raw_path> [<insert ts>] [<batch id>]
       python -m aerolake.jobs build <raw_path> <warehouse_root>
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import loads, snapshots, storage
from aerolake.operators import quality as D
from aerolake.operators import quality_state as Q
from aerolake.operators.incremental import high_water_mark, upsert
from aerolake.plans import dims, layers
from aerolake.plans.fact import FACT_COLUMNS, fct_flights
from aerolake.plans.staging import stg_flights, stg_flights_since
from aerolake.functions.clean import silver_key
from aerolake.session import build_session, fresh_path, local_rows, side_by_side
from aerolake.sources import ingest as I
from aerolake.sources import sinks as S
from aerolake.sources.schemas import BRONZE_EXTRA_FIELDS, STATE_VECTOR_FIELDS, ordered_schema
from aerolake.sources.tables import source
from aerolake.storage import path_exists


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


class ContractBroken(Exception):
    """An ingest in ``fail`` mode met inputs that break the contract."""


def ingest(spark: SparkSession, input_path: str, parquet_root: str, processing_date: str, batch_id: str | None = None,
           layout: str = "document", on_violation: str = "fail") -> dict:
    """Batch files -> typed Parquet under ``processing_date=<date>/batch_id=<id>``.

    ``batch_id`` names the poll (default: the time); polls of a day stay side by
    side and repeating one replaces it.  ``fail`` aborts on any malformed input
    or row of the wrong width, and nothing is kept; ``quarantine`` lands them
    under ``<root>_quarantine`` with the reason.  The input is parsed once, into
    a staged copy from which everything is counted and written; a batch without
    rows is a no-op."""
    batch_id = batch_id or _now().replace(" ", "T").replace(":", "")
    stage = fresh_path(spark, "ingest-stage")
    I.classified_inputs(spark, input_path, layout).write.parquet(stage)
    staged = spark.read.parquet(stage)
    counts = staged.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("problem") == I.MALFORMED).alias("malformed"),
        F.count_if(F.col("problem") == I.BAD_WIDTH).alias("bad_width"),
        F.coalesce(F.sum(F.when(F.col("problem").isNull(), I.failed_casts())), F.lit(0)).alias("failed_casts")).first().asDict()
    bad = counts["malformed"] + counts["bad_width"]
    if bad and on_violation == "fail":
        storage.delete(spark, stage)
        raise ContractBroken(f"CONTRACT BROKEN: {counts}")
    keys = {"processing_date": F.lit(processing_date).cast("date"), "batch_id": F.lit(batch_id)}
    name = f"processing_date={processing_date}/batch_id={batch_id}"
    root = parquet_root.rstrip("/")
    counts["rows_out"] = 0
    if counts["rows_in"] > bad:
        good = I.typed_projection(staged.where("problem is null"))
        content = S.ContentReconciliation(good.columns)
        S.write_partitions(content.tap(good, "in").withColumns(keys), root, list(keys))
        landed = content.of(spark.read.schema(good.schema).parquet(f"{root}/{name}"))
        counts["rows_out"] = int(landed[0])
        if landed != content.digest("in"):
            raise ContractBroken(f"contents do not agree: {counts}")
    if counts["rows_in"] != counts["rows_out"] + bad:
        raise ContractBroken(f"counts do not agree: {counts}")
    if bad:
        S.write_partitions(staged.where("problem is not null").withColumns(keys), f"{root}_quarantine", list(keys), fmt="json")
    if counts["rows_in"]:
        # what an earlier try of this poll left on a side that has no rows now
        for side, rows in ((root, counts["rows_out"]), (f"{root}_quarantine", bad)):
            if not rows:
                storage.delete(spark, f"{side}/{name}")
    storage.delete(spark, stage)
    return counts


def _state(root: str, name: str) -> str:
    return layers.layer_path(root, "_state", name)


def _read_state(spark: SparkSession, path: str):
    """A one-row table's ``value``, or None."""
    storage.recover_table(spark, path)
    return spark.read.parquet(path).first()["value"] if path_exists(spark, path) else None


def _write_state(spark: SparkSession, path: str, value) -> None:
    storage.replace_table(local_rows(spark, [(value,)], f"value {'string' if isinstance(value, str) else 'bigint'}").coalesce(1), path)


def load(spark: SparkSession, parquet_root: str, processing_date: str, raw_path: str,
         inserted_at: str | None = None, batch_id: str | None = None) -> int:
    """One processing date (or one batch of it) into the bronze table, under
    ``load_id``; returns rows loaded.

    Loading the same again replaces it, with the same ids if there are as many rows.
    Ids are dense over all loads: the ledger of loads tells the next one, so bronze is
    never scanned for it, and a load is not there before its entry is."""
    folder = f"{parquet_root.rstrip('/')}/processing_date={processing_date}" + (f"/batch_id={batch_id}" if batch_id else "")
    if not path_exists(spark, folder):
        return 0
    part = spark.read.option("basePath", parquet_root).parquet(folder)
    n = part.count()                            # from the footers
    if not n:
        return 0
    load_id = processing_date + (f"_{batch_id}" if batch_id else "")
    name = f"processing_date={processing_date}/load_id={load_id}"
    stamp = inserted_at or _now()

    def write(first_id: int) -> str:
        rows = S.with_dense_ids(part, first_id).drop("batch_id").withColumns(
            {"inserted_at": F.lit(stamp).cast("timestamp_ntz"), "load_id": F.lit(load_id)})
        S.write_partitions(rows, raw_path, ["processing_date", "load_id"])
        written = spark.read.parquet(f"{raw_path.rstrip('/')}/{name}")
        return "-".join(map(str, written.agg(*S.content_digest(sorted(written.columns))).first()))

    return loads.record(spark, raw_path, name, n, stamp, write)["n_rows"]


def read_mark(spark: SparkSession, root: str) -> str | None:
    """The greatest insert time built so far (a one-row table), so that a run over
    bronze without a ledger does not scan the whole fact for it."""
    return _read_state(spark, _state(root, "fct_flights_high_water_mark"))


def _declared_suite():
    from aerolake.plans.q_quality import SUITE
    return SUITE


SILVER_KEY_COL = "silver_key"
VERSION = ["inserted_at", "id_surrogate"]       # newest insert wins, then the greatest id
DIMENSIONS = ("dim_airports", "dim_aircrafts", "dim_calendar")


def _with_silver_key(stg: DataFrame) -> DataFrame:
    """A single-column key for (aircraft, second) that is never NULL: a missing
    part has a mark of its own, so that it equals only another missing one."""
    return stg.withColumn(SILVER_KEY_COL, silver_key("aircraft_id", "position_timestamp")).withColumn(
        "flight_date", F.to_date("position_timestamp"))


def _fresh(spark: SparkSession, raw_path: str, root: str, mark: str | None) -> tuple[DataFrame, list[dict] | None]:
    """Silver rows of what is new in bronze, and the loads taken (None: no ledger)."""
    if not loads.has_ledger(spark, raw_path):
        return stg_flights_since(source(spark, {"raw.flights_raw": raw_path}, "raw", "flights_raw"), mark), None
    taken = loads.pending(spark, raw_path, _state(root, "built_loads"))
    if names := [e["load"] for e in taken if e["n_rows"]]:
        return stg_flights(loads.read_loads(spark, raw_path, names)), taken
    bronze = ordered_schema(STATE_VECTOR_FIELDS + BRONZE_EXTRA_FIELDS)
    return stg_flights(local_rows(spark, [], bronze)), taken


def _apply(spark: SparkSession, new: DataFrame, taken: list[dict] | None, root: str, stored: dict[str, DataFrame | None],
           silver_path: str, fact_path: str) -> tuple[str | None, dict[str, DataFrame], dict[str, DataFrame | None]]:
    """The new silver rows into silver, fact and dimensions.  Returns their greatest
    insert time, the dimensions, and the fact rows set aside in this run, by its name."""
    stage = fresh_path(spark, "build-fresh")
    fresh = storage.replace_table(_with_silver_key(new), f"{stage}/stg_flights")      # read by all below
    new_mark = high_water_mark(fresh, "inserted_at")
    # a folder name of the same run, if repeated
    run_id = re.sub(r"\D", "", new_mark or "none") if taken is None else uuid.uuid5(
        uuid.NAMESPACE_OID, " ".join(f"{e['load']} {e['attempt']}" for e in taken)).hex
    table = lambda df, name: layers.materialise(df, name, "table", root=root)      # noqa: E731
    airports = table(dims.dim_airports(spark), "dim_airports")
    rows = fct_flights(fresh, airports, n_airports=dims.N_AIRPORTS, keep=["id_surrogate"])
    _, aircrafts, calendar, fact = side_by_side(
        spark,
        lambda: upsert(spark, silver_path, fresh, SILVER_KEY_COL, "flight_date", order_by=VERSION, stored=True, one_version=True),
        lambda: table(dims.merge_aircrafts(stored["dim_aircrafts"], fresh), "dim_aircrafts"),
        lambda: table(dims.merge_calendar(stored["dim_calendar"], fresh), "dim_calendar"),
        lambda: upsert(spark, fact_path, rows, "flight_pk", "flight_date", order_by=["ingestion_timestamp", "id_surrogate"],
                       on_null_key="quarantine", run_id=run_id, one_version=True))
    dim_tables = {"dim_airports": airports, "dim_aircrafts": aircrafts, "dim_calendar": calendar}
    aside: dict[str, DataFrame | None] = {}
    if new_mark is not None:
        at = f"{fact_path}_rejected/run_id={run_id}"
        aside[f"rejected {run_id}"] = spark.read.schema(rows.schema).parquet(at) if fact["rejected_rows"] else None
    storage.delete(spark, stage)
    return new_mark, dim_tables, aside


def build(spark: SparkSession, raw_path: str, root: str, full_checks: bool = False) -> DataFrame:
    """One model run over the bronze table; returns the DQ verdict table.

    New are the loads in the ledger that no build has taken (bronze without a ledger:
    the rows above the kept mark).  They are deduplicated among themselves and upserted
    into the silver table and, as fact rows, into the fact, where the newest version of
    a key stays, so a load may come late.  Fact rows without a key (no id or no time)
    go to ``fct_flights_rejected`` and show in the not_null check.  Dimensions are
    merged from their stored rows and the new ones.

    The verdict covers the whole tables, from the state kept by partition
    (``quality_state``): a run reads the partitions that changed since their state was
    written, a run without new rows reads none and keeps the verdict.  ``full_checks``
    describes every partition anew.
    """
    silver_path, fact_path = layers.layer_path(root, "silver", "stg_flights"), layers.layer_path(root, "gold", "fct_flights")
    mark = read_mark(spark, root)
    new, taken = _fresh(spark, raw_path, root, mark)
    idle = taken is not None and not any(e["n_rows"] for e in taken)
    dim_tables = {name: layers.stored_layer(spark, root, "gold", name) for name in DIMENSIONS}
    new_mark, aside = None, {}
    if not idle or None in dim_tables.values() or not (snapshots.exists(spark, silver_path) and snapshots.exists(spark, fact_path)):
        new_mark, dim_tables, aside = _apply(spark, new, taken, root, dim_tables, silver_path, fact_path)

    suite, state = _declared_suite(), _state(root, "quality")
    tables = {"stg_flights": silver_path, "fct_flights": fact_path}
    of = lambda model: [c for c in suite if c.model == model]      # noqa: E731
    side_by_side(
        spark,
        lambda: Q.refresh(spark, state, "stg_flights", silver_path, SILVER_KEY_COL, of("stg_flights"), dim_tables, everything=full_checks),
        lambda: Q.refresh(spark, state, "fct_flights", fact_path, "flight_pk", of("fct_flights"), dim_tables, aside, full_checks))
    verdict = D.dq_run(dim_tables, [c for c in suite if c.model in dim_tables]).unionByName(
        Q.verdict(spark, state, tables, suite, dim_tables))
    report = layers.materialise(verdict, "dq_report", "table", root=root)

    # written last: after a failure before it the same rows are applied again, which
    # changes nothing
    if taken:
        loads.mark_built(spark, _state(root, "built_loads"), taken)
    if new_mark is not None and (mark is None or new_mark > mark):
        _write_state(spark, _state(root, "fct_flights_high_water_mark"), new_mark)
    side_by_side(spark, *[lambda path=path: snapshots.sweep(spark, path) for path in (silver_path, fact_path, state)])
    return report


def main(argv: list[str]) -> None:
    # the master comes from spark-submit; AEROLAKE_MASTER=local[*] for a laptop run
    spark = build_session(master=os.environ.get("AEROLAKE_MASTER"), shuffle_partitions=None)
    cmd, args = argv[0], argv[1:]
    if cmd == "ingest":
        print(ingest(spark, *args))
    elif cmd == "load":
        print(load(spark, *args))
    elif cmd == "build":
        build(spark, *args).show(truncate=False)
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
