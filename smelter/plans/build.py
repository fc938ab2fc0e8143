"""Build the layers in dependency order and report on every step."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.plans import gold, silver
from smelter.scratch import release
from smelter.sources.tables import Bucketed, Layer, Parts, Snapshot
from smelter.sources.unique import KeyRegistry
from smelter.sources.versions import Folder
from smelter.specs import SOURCE_TABLES
from smelter.steps import StepsFailed, report, run_steps
from smelter.streaming.fold import BUCKETS, STATES, Fold, changed_since, last_run
from smelter.streaming.ingest import register_bronze, vacuum


# Independent tables built beside each other.
AT_ONCE = 3


def build_silver(bronze: Layer, layer: Layer, deletes: str = "apply") -> list[str]:
    """All silver tables from the bronze change logs."""

    def step(table: str):
        return lambda: layer.replace(
            table, silver.from_changes(table, bronze.read(table), deletes)
        )

    return run_steps({table: step(table) for table in SOURCE_TABLES}, AT_ONCE)


def refresh_silver(bronze_root: str, layer: Layer, deletes: str = "apply", buckets: int = BUCKETS) -> list[str]:
    """All silver tables from the batches committed since the last run; tables without new ones stay as they are."""

    def step(table: str):
        return lambda: Fold(layer, SOURCE_TABLES[table], buckets, deletes).run(bronze_root)

    return run_steps({table: step(table) for table in SOURCE_TABLES}, AT_ONCE)


def dimension(
    table: str, read: Callable[[str], DataFrame], previous: gold.Previous = None
) -> DataFrame:
    """A dimension from silver; members of ``previous`` keep their keys."""
    builders = {
        "dim_geography": lambda: gold.dim_geography(read("geolocation"), previous),
        "dim_date": lambda: gold.dim_date(read("orders"), read("order_reviews")),
        "dim_customer": lambda: gold.dim_customer(read("customers"), previous),
        "dim_seller": lambda: gold.dim_seller(read("sellers"), previous),
        "dim_product": lambda: gold.dim_product(
            read("products"), read("category_translation"), previous
        ),
        "dim_order_status": lambda: gold.dim_order_status(read("orders"), previous),
    }
    return builders[table]()


DIMENSIONS = (
    "dim_geography",
    "dim_date",
    "dim_customer",
    "dim_seller",
    "dim_product",
    "dim_order_status",
)
FACTS = ("fact_order_items", "fact_reviews")

# Dimensions stored bucketed by the business key that facts look up. They come from their registries partitioned so.
LOOKED_UP = {
    "dim_geography": "zip_code_prefix",
    "dim_customer": "customer_unique_id",
    "dim_seller": "seller_id",
    "dim_product": "product_id",
}


def fact(
    table: str, read_silver: Callable[[str], DataFrame], read_gold: Callable[[str], DataFrame]
) -> DataFrame:
    if table == "fact_reviews":
        return gold.fact_reviews(read_silver("order_reviews"), read_gold("fact_order_items"))
    return gold.fact_order_items(
        read_silver("order_items"),
        read_silver("orders"),
        read_silver("customers"),
        *[
            read_gold(d)
            for d in ("dim_customer", "dim_seller", "dim_product", "dim_order_status", "dim_geography")
        ],
    )


def _fact_parts(layer: Layer, table: str, folders: Mapping[str, str], rows: DataFrame) -> Parts:
    """A fact put together from month folders."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != gold.MONTH)
    key = gold.FACT_KEYS[table]
    schema = columns if key in rows.columns else f"{key} bigint, {columns}"
    return Parts(schema, f"{gold.MONTH} int", [({gold.MONTH: int(m)}, path) for m, path in sorted(folders.items())])


def _months(layer: Layer, path: str) -> dict[str, str]:
    """Folder by month of a staged fact."""
    prefix = f"{gold.MONTH}="
    return {n.removeprefix(prefix): f"{path}/{n}" for n in Folder(layer.spark, path).names() if n.startswith(prefix)}


def _silver_runs(at: Snapshot) -> dict[str, int | None]:
    return {t: last_run(at, spec) if at.exists(t) else None for t, spec in SOURCE_TABLES.items()}


def build_gold(silver_layer: Layer, layer: Layer, buckets: int = BUCKETS) -> list[str]:
    """Write all eight tables, facts from the new dimensions, then publish them in one release.

    Silver is read as of one release of its own. Members of dimensions get their keys from registries in so many ``buckets``, and
    the dimensions that facts look up are bucketed alike. If any step fails nothing is published; readers of ``layer.snapshot()``
    always see tables of one build.
    """
    return _build_gold(silver_layer, layer, None, buckets)


def refresh_gold(silver_layer: Layer, layer: Layer, buckets: int = BUCKETS) -> list[str]:
    """Like ``build_gold``, but facts are rebuilt only in the months that changed since the last build.

    Needs silver tables made by ``refresh_silver`` and a gold layer built from an earlier state of them; otherwise everything is
    built. Dimensions are always rebuilt: members keep their keys.
    """
    at, before = silver_layer.snapshot(), layer.snapshot()
    built = before.notes.get(BUILT)
    if not built or not all(before.exists(t) and before.folders(t) for t in FACTS):
        return _build_gold(silver_layer, layer, None, buckets)
    changed = {t: changed_since(silver_layer, spec, at, built["runs"].get(t)) for t, spec in SOURCE_TABLES.items()}
    earlier = _release_of(silver_layer, before)
    if any(keys is None for keys in changed.values()) or not all(earlier.stored(t) for t in COMPARED):
        return _build_gold(silver_layer, layer, None, buckets)
    return _build_gold(silver_layer, layer, changed, buckets)


BUILT = "built_from"  # the note on which silver release gold was built from
COMPARED = ("orders", "order_reviews")  # silver tables that a refresh of gold also reads as of the last build


def _build_gold(
    silver_layer: Layer, layer: Layer, changed: Mapping[str, DataFrame] | None, buckets: int
) -> list[str]:
    at, before = silver_layer.snapshot(), layer.snapshot()
    staged: dict[str, str | Parts | Bucketed] = {}

    def stage_dimension(table: str):
        def step():
            def keyed(members: DataFrame, business_key: str, key: str) -> DataFrame:
                registry = KeyRegistry(layer, table, business_key, key, buckets)
                return registry.assign(members, before.read(table) if before.exists(table) else None)

            rows = dimension(table, at.read, keyed)
            if table in LOOKED_UP:
                staged[table] = layer.stage_bucketed(table, rows, buckets, [LOOKED_UP[table]])
            else:
                staged[table] = layer.stage(table, rows)

        return step

    def new_dimension(table: str) -> DataFrame:
        stored = staged[table]
        return layer.load_bucketed(stored) if isinstance(stored, Bucketed) else layer.load(stored)

    def stage_all(table: str) -> None:
        def read(name: str) -> DataFrame:
            return new_dimension(name) if name in DIMENSIONS else layer.load_all(list(items.values()))

        rows = fact(table, at.read, read)
        path = gold.stage_fact(layer, table, rows)
        months = _months(layer, path)
        staged[table] = _fact_parts(layer, table, months, rows)
        if table == "fact_order_items":
            items.update(months)

    def stage_months(table: str) -> None:
        old = before.folders(table)
        if table == "fact_order_items":
            months, rows = refresh.items(new_dimension)
        else:
            months, rows = refresh.reviews(layer.load_all(list(items.values())))
        first = before.read(table).agg(F.max(gold.FACT_KEYS[table])).first()[0] or 0
        fresh = _months(layer, gold.stage_fact(layer, table, rows, first))
        kept = {m: path for m, path in old.items() if int(m) not in months}
        staged[table] = _fact_parts(layer, table, kept | fresh, before.read(table))
        if table == "fact_order_items":
            items.update(kept | fresh)

    items: dict[str, str] = {}
    refresh = None
    done: list[str] = []
    try:
        done += run_steps({table: stage_dimension(table) for table in DIMENSIONS}, AT_ONCE)
        if changed is not None:
            earlier = _release_of(silver_layer, before)
            refresh = gold.ChangedMonths(changed, earlier.read, at.read, before.read, new_dimension)
        # The review fact reads the item fact, so the first failure ends the facts.
        for table in FACTS:
            step = stage_all if refresh is None else stage_months
            done += run_steps({table: lambda: step(table)})
    except StepsFailed as error:
        raise StepsFailed(done + error.done, error.failed) from None
    layer.publish(staged, {BUILT: {"release": at.number, "runs": _silver_runs(at)}}, based_on=before)
    return done


def _release_of(silver_layer: Layer, before: Snapshot) -> Snapshot:
    """Silver as of the last build of gold."""
    return silver_layer.snapshot(before.notes[BUILT]["release"])


def remove_old(bronze: Layer, silver_layer: Layer, gold_layer: Layer, built: bool = True) -> None:
    """Remove what neither the latest releases nor the next incremental run read; readers of anything older must be done.

    That is merged batches, states and silver tables before the last, and shuffle files of finished jobs; and if gold is ``built`` from
    the latest silver, gold tables before the last, and the silver tables that gold is compared with.
    """
    vacuum(bronze.spark, bronze.root)
    release(bronze.spark)
    if silver_layer.releases().numbers():
        silver_layer.expire_all(f"{table}_{part}" for table in SOURCE_TABLES for part in STATES)
        silver_layer.expire_all(t for t in SOURCE_TABLES if t not in COMPARED)
    before = gold_layer.snapshot()
    if built and BUILT in before.notes:
        since = [n for n in silver_layer.releases().numbers() if n >= before.notes[BUILT]["release"]]
        silver_layer.expire_all(COMPARED, len(since))
        gold_layer.expire_all(before.entries)


class BuildFailed(RuntimeError):
    """A build did not succeed; ``report`` has a row per step."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def run(
    bronze: Layer,
    silver_layer: Layer,
    gold_layer: Layer,
    ingest: Callable[[], list[str]] | None = None,
    incremental: bool = False,
    buckets: int = BUCKETS,
    keep_old: bool = True,
) -> DataFrame:
    """Ingest if given, then silver, then gold; one report row per step, with the rows stored.

    ``incremental``: silver folds only the batches that are new, into states of so many ``buckets``, and gold rebuilds only
    the months that changed. Without ``keep_old`` each layer that succeeded is tidied up at once, so that disks hold little more than
    the latest releases; see ``remove_old``.

    After an ingest the bronze tables are registered again, so that silver sees its batches. A layer with a
    failed step still runs its other steps, and stops the next layer; the report then comes with
    ``BuildFailed``.
    """

    def ingested() -> list[str]:
        done = ingest()
        registered, failed = register_bronze(bronze, SOURCE_TABLES.values())
        if failed:
            raise StepsFailed(done + registered, {t: RuntimeError(why) for t, why in failed.items()})
        return done

    def built_silver() -> list[str]:
        if incremental:
            return refresh_silver(bronze.root, silver_layer, buckets=buckets)
        return build_silver(bronze, silver_layer)

    stages = [
        (None, ingested) if ingest else None,
        (silver_layer, built_silver),
        (gold_layer, lambda: (refresh_gold if incremental else build_gold)(silver_layer, gold_layer, buckets)),
    ]
    planned = {silver_layer: list(SOURCE_TABLES), gold_layer: [*DIMENSIONS, *FACTS]}
    done: dict[str, int | None] = {}
    failed: Mapping[str, Exception] = {}
    for layer, stage in filter(None, stages):
        try:
            names = stage()
        except StepsFailed as error:
            names, failed = error.done, error.failed
        published = layer is not None and not (failed and layer is gold_layer)
        done |= {name: layer.read(name).count() if published else None for name in names}
        if failed:
            break
        if not keep_old:
            remove_old(bronze, silver_layer, gold_layer, built=layer is gold_layer)
    skipped = [t for tables in planned.values() for t in tables if t not in done and t not in failed]
    outcome = report(gold_layer.spark, done, failed, skipped)
    if failed:
        reasons = "; ".join(f"{name}: {error}" for name, error in failed.items())
        raise BuildFailed(f"{len(failed)} steps failed: {reasons}", outcome)
    return outcome
