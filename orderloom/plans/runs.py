"""Layer runs: read tables, apply the plans, write tables.

Silver runs in foreign-key order; Gold builds the fact once and reads it back for the marts.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.functions.cleaning import as_bigint
from orderloom.functions.periods import month_of, months_of, next_month, ordered, weeks_of_months
from orderloom.operators.dealing import as_stored, crowded, slices_of
from orderloom.operators.dedupe import collapse_exact
from orderloom.operators.integrity import REASON
from orderloom.operators.upsert import UpsertResult, in_partitions, partition_values, upsert
from orderloom.plans import deltas, gold, silver
from orderloom.plans.gold import DAY, MONTH_START, PRODUCT_COLUMNS, WEEK
from orderloom.schemas import BRONZE, CORRUPT, INGEST_TS, MONTH, SILVER_KEYS, SILVER_LAYOUT, UPDATED_TS, contract
from orderloom.session import broadcasts, tune
from orderloom.sources.lake import Lake, Replacement, Scratch

BRONZE_OF = {
    "silver_customers": "bronze_customers",
    "silver_products": "bronze_products",
    "silver_orders": "bronze_orders",
    "silver_order_items": "bronze_order_items",
}
FACT = "gold_fact_order_items"
DIM_CUSTOMER, DIM_PRODUCT, DIM_ORDER = "gold_dim_customer", "gold_dim_product", "gold_dim_order"
DAILY, WEEKLY, MONTHLY = (
    "gold_product_daily_sales",
    "gold_product_weekly_sales",
    "gold_product_monthly_sales",
)
STATUS_VIEW = "gold_vw_order_status"


# ---- Silver -----------------------------------------------------------------------------


class Counts:
    """Rows that a run accepted and rejected, by reason: counted while they are written, without a pass of their own."""

    def __init__(self) -> None:
        self._observed: list[tuple[str, Observation]] = []

    def observe(self, table: str, tagged: DataFrame) -> DataFrame:
        """`tagged`, whose rows are counted when they are first computed."""
        seen = Observation()
        self._observed.append((table, seen))
        reason = F.col(REASON)
        found = [F.count_if(reason == r).alias(r) for r in silver.REASONS]
        return tagged.observe(seen, F.count_if(reason.isNull()).alias(ACCEPTED), *found)

    def by_table(self) -> dict[str, dict[str, int]]:
        """Rows by table and reason, as landed; reasons without rows are left out."""
        sums: dict[str, dict[str, int]] = {}
        for table, seen in self._observed:
            own = sums.setdefault(table, {})
            for reason, n in seen.get.items():
                if n:
                    own[reason] = own.get(reason, 0) + n
        return sums

    def log(self) -> None:
        for table, found in self.by_table().items():
            _log.info("%s: %s", table, ", ".join(f"{n} {reason}" for reason, n in found.items()) or "no rows")


ACCEPTED = "accepted"
_log = logging.getLogger(__name__)


def checked_rows(
    lake: Lake, table: str, landed: DataFrame, scratch: Scratch, counts: Counts | None = None
) -> DataFrame:
    """Landed rows tagged by what is wrong with them, given the parents in Silver now.

    Where parents are joined the result is written, since both the table and its quarantine
    come from it. Columns that only the source has stay in Bronze. With `counts` the rows are
    counted by what is wrong with them when they are written.
    """
    observe = counts.observe if counts else lambda _, tagged: tagged
    known = [c for c in [*BRONZE[BRONZE_OF[table]].names, CORRUPT] if c in landed.columns]
    landed = landed.select(*known)
    if table == "silver_customers":
        return observe(table, silver.tagged_customers(landed))
    if table == "silver_products":
        return observe(table, silver.tagged_products(landed))
    if table == "silver_orders":
        checked = silver.tagged_orders(landed, lake.read("silver_customers"))
    else:
        orders, products = lake.read("silver_orders"), lake.read("silver_products")
        checked = silver.tagged_order_items(landed, orders, products)
    return scratch.stage(observe(table, checked), f"{table}-checked")


def run_silver(
    lake: Lake,
    rebuild: bool = True,
    since: dt.datetime | None = None,
    most_partitions: int | None = None,
    passes: int = 1,
) -> dict[str, dict[str, int]]:
    """Bronze to Silver: from scratch, or by upsert of the rows ingested after `since`.

    Returns the rows of each table by what became of them (`accepted` or the reason of the
    rejection), and logs them.

    A rebuild takes each landing table in `passes`, dealt by a hash of the key: all versions of
    a row are in one pass, and no shuffle spans more than that share of the table. The parents
    that a pass refers to are their keys alone.
    """
    tune(lake.spark, *[lake.path(b) for b in BRONZE_OF.values()], most_partitions=most_partitions)
    counts = Counts()
    for table, bronze in BRONZE_OF.items():
        landed = lake.read(bronze)
        if rebuild:
            _rebuild(lake, table, landed, passes, counts)
        else:
            if since is not None:
                landed = landed.where(F.col(INGEST_TS) > F.lit(since))
            absorb(lake, table, landed, counts=counts)
    counts.log()
    return counts.by_table()


def _rebuild(lake: Lake, table: str, landed: DataFrame, passes: int, counts: Counts) -> None:
    with Scratch(lake.spark) as scratch:
        share = F.pmod(F.xxhash64(as_bigint(SILVER_KEYS[table][0])), F.lit(passes))
        parts = [landed] if passes == 1 else [landed.where(share == n) for n in range(passes)]
        checked = [checked_rows(lake, table, part, scratch, counts) for part in parts]
        rows = (silver.newest_accepted(part, table) for part in checked)
        lake.publish_parts(table, rows, SILVER_LAYOUT[table])
        kept = [silver.quarantined(part, BRONZE_OF[table]) for part in checked]
        lake.publish_parts(f"{table}_rejected", (final for final, _ in kept))
        lake.publish_parts(f"{table}_orphans", (_by_slot(waiting, table) for _, waiting in kept))


# Rows of the second table wait for rows of the first, by this key, if rejected for this reason.
WAITING = [
    ("silver_customers", "silver_orders", "customer_id", silver.ORPHAN_CUSTOMER),
    ("silver_orders", "silver_order_items", "order_id", silver.ORPHAN_ORDER),
    ("silver_products", "silver_order_items", "product_id", silver.ORPHAN_PRODUCT),
]
#: Slots that waiting rows are dealt to by the key they wait for, and batches after which those that wait are stored anew.
SLOTS, COMPACT_AFTER = 256, 4
_SLOT = "_slot"


def _slot_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def _by_slot(waiting: DataFrame, table: str) -> DataFrame:
    """Waiting rows in the order of the keys they wait for, so that a few keys read few row groups."""
    slot = F.lit(None).cast("int")
    for _, child, key, reason in WAITING:
        if child == table:
            slot = F.when(F.col(REASON) == reason, _slot_of(as_bigint(key))).otherwise(slot)
    rows = waiting.withColumn(_SLOT, slot)
    return rows.repartitionByRange(_SLOT).sortWithinPartitions(_SLOT)


def absorb(
    lake: Lake, table: str, landed: DataFrame, batch: str | None = None, counts: Counts | None = None
) -> list[dt.date | None]:
    """Upsert landed rows into a Silver table; the newest version of a key wins.

    Rows that waited for a key of this batch are absorbed after it. Absorbing the same rows
    twice changes nothing, and batches may come in any order. Returns the order months whose
    rows were rewritten; they are noted under the lake's root as well, before anything
    changes, until Gold has taken them in. Rejected rows are appended under the name of the
    `batch`, so that a batch that runs again does not add them again. Rows are counted by what
    became of them, in `counts` where given, and logged otherwise.
    """
    lake.recover(*BRONZE_OF)
    finish_moves(lake)
    own = Counts() if counts is None else counts
    with Scratch(lake.spark) as scratch:
        checked = checked_rows(lake, table, landed, scratch, own)
        good = scratch.stage(silver.newest_accepted(checked, table), f"{table}-good")
        touched = _upsert(lake, table, good, UPDATED_TS, stored=True)
        touched |= set(finish_moves(lake))
        final, waiting = silver.quarantined(checked, BRONZE_OF[table])
        lake.append(f"{table}_rejected", final, batch)
        lake.append(f"{table}_orphans", _by_slot(waiting, table), batch)
        for parent, child, key, reason in WAITING:
            if parent == table and lake.exists(f"{child}_orphans"):
                again = _waiting_for(lake, child, key, reason, good)
                again = scratch.stage(again, f"{child}-again")
                if not again.isEmpty():
                    name = f"{batch}-{key}" if batch else None
                    touched |= set(absorb(lake, child, again, name))
                _compact_waiting(lake, child)
        _compact_waiting(lake, table)
    if counts is None:
        own.log()
    return ordered(touched)


def _compact_waiting(lake: Lake, table: str) -> None:
    """Store the rows that still wait anew once there are many batches of them, without those that do not.

    What a batch of parents reads depends on the rows that wait, not on all that ever waited.
    """
    name = f"{table}_orphans"
    if lake.batches(name) > COMPACT_AFTER:
        lake.publish(name, _by_slot(_still_waiting(lake, table), table))


def _upsert(lake: Lake, table: str, rows: DataFrame, newest: str | None, stored: bool = False) -> set[dt.date | None]:
    """Upsert, with a note of what Gold has to refresh (months, and orders in them) and of orders that moved."""

    def tell(change: UpsertResult) -> None:
        if SILVER_LAYOUT[table] and change.touched:
            lake.note("months", _stale_months(change.touched, change.changed))
        if change.moved:
            lake.note("moved", change.moved)

    key, layout, orders = SILVER_KEYS[table], SILVER_LAYOUT[table], table == "silver_orders"
    keep = "order_id" if layout else None
    done = upsert(lake, table, rows, key, layout, newest, before_swap=tell, keep_moved=orders, keep=keep, stored=stored)
    return set(done.touched)


def _stale_months(months: list[dt.date | None], orders: str | None = None) -> dict:
    """Content of a note: months of Gold that are out of date, for the orders kept under this name or for all."""
    return {"months": [m and m.isoformat() for m in months], "orders": orders}


def _months_in(note: dict) -> list[dt.date | None]:
    return [m and dt.date.fromisoformat(m) for m in note["months"]]


def _forget_stale(lake: Lake, stale: dict[str, dict]) -> None:
    lake.forget(stale)
    for note in stale.values():
        if note["orders"]:
            lake.drop_kept(note["orders"])


def _waiting_for(lake: Lake, child: str, key: str, reason: str, parents: DataFrame) -> DataFrame:
    """Rows of a child table that wait for one of these parents."""
    # At most SLOTS values.
    slots = [r[0] for r in parents.select(_slot_of(F.col(key))).distinct().collect()]
    waiting = lake.read(f"{child}_orphans").where(F.col(_SLOT).isin(slots) & (F.col(REASON) == reason))
    waiting = waiting.withColumn("_key", as_bigint(key))
    found = waiting.join(parents.select(F.col(key).alias("_key")), "_key", "left_semi")
    return collapse_exact(found.drop("_key", REASON, _SLOT), INGEST_TS)


def _still_waiting(lake: Lake, table: str) -> DataFrame:
    """Logged orphans whose parent has not come; exact copies once."""
    logged = lake.read(f"{table}_orphans").drop(_SLOT)
    still = logged.where("false")
    for parent, child, key, reason in WAITING:
        if child == table:
            known = lake.read(parent).select(F.col(key).alias("_known"))
            rows = logged.where(F.col(REASON) == reason)
            still = still.unionByName(rows.join(known, as_bigint(key) == F.col("_known"), "left_anti"))
    return collapse_exact(still, INGEST_TS)


def quarantine(lake: Lake, table: str) -> DataFrame:
    """Rows that are not in Silver, with the reason; exact copies once.

    Orphans are kept as a log. Those whose parent has come since are left out here.
    """
    final = lake.read(f"{table}_rejected")
    rows = final.unionByName(_still_waiting(lake, table), allowMissingColumns=True)
    return collapse_exact(rows, INGEST_TS)


def finish_moves(lake: Lake) -> list[dt.date | None]:
    """Store lines under the month of their order where the order has moved to another.

    The orders are noted before they move, so lines follow also if the driver was lost in
    between. Their month now is what counts, whatever it was when they were noted.
    """
    touched: set[dt.date | None] = set()
    table = "silver_order_items"
    for name, kept in lake.notes("moved").items():
        if lake.exists(table):
            moved = lake.spark.read.parquet(lake.kept_path(kept))
            months = partition_values(moved, f"_old_{MONTH}")
            lines = in_partitions(lake.read(table), MONTH, months)
            orders = lake.read("silver_orders").select("order_id", MONTH)
            orders = orders.join(moved.select("order_id").distinct(), "order_id", "left_semi")
            here = F.col("_here").eqNullSafe(F.col(MONTH))
            lines = lines.withColumnRenamed(MONTH, "_here").join(orders, "order_id").where(~here)
            touched |= _upsert(lake, table, lines.drop("_here"), None)
        lake.forget([name])
        lake.drop_kept(kept)
    return ordered(touched)


# ---- Gold -------------------------------------------------------------------------------


def run_gold(
    lake: Lake, months_per_pass: int | None = None, most_partitions: int | None = None
) -> None:
    """Silver to Gold: fact, dimensions, marts, status view; everything is overwritten.

    With `months_per_pass` the fact and the marts by day are computed for so many months at a
    time, and no shuffle spans more than these. An order has one month, so the parts add up.
    """
    tune(lake.spark, *[lake.path(s) for s in BRONZE_OF], most_partitions=most_partitions)
    lake.recover(*BRONZE_OF)
    finish_moves(lake)
    stale = lake.notes("months")
    items, orders = lake.read("silver_order_items"), lake.read("silver_orders")
    products, customers = lake.read("silver_products"), lake.read("silver_customers")

    passes = _passes(items, months_per_pass)
    fit = gold.names_fit(products)
    facts = (
        gold.fact_order_items(_months(items, part), _months(orders, part), products, dealt=fit)
        for part in passes
    )
    lake.publish_parts(FACT, facts, MONTH, dealt=fit)
    lake.publish(DIM_CUSTOMER, gold.dim_customer(customers))
    lake.publish(DIM_PRODUCT, gold.dim_product(products))

    fact, names = lake.read(FACT), lake.read(DIM_PRODUCT)
    fit = gold.names_fit(names)
    days = (gold.stored_mart_daily(_months(fact, part), names, fit) for part in passes)
    lake.publish_parts(DAILY, days, MONTH, sort_by=DAY, dealt=fit)
    daily, large = lake.read(DAILY), slices_of(lake.stored_files(DAILY, MONTH))
    weekly = gold.stored_roll_up(daily, names, WEEK, fit, large)
    lake.publish(WEEKLY, weekly, MONTH, sort_by=WEEK, dealt=fit)
    monthly = gold.stored_roll_up(daily, names, MONTH_START, fit, large)
    lake.publish(MONTHLY, monthly, MONTH_START, dealt=fit)
    create_status_view(lake)
    _forget_stale(lake, stale)


def _passes(items: DataFrame, months_per_pass: int | None) -> list[list[dt.date | None] | None]:
    """Groups of the months that have lines; None stands for all of them at once."""
    if not months_per_pass:
        return [None]
    months = partition_values(items, MONTH)
    return [months[i : i + months_per_pass] for i in range(0, len(months), months_per_pass)] or [None]


def _months(rows: DataFrame, months: list[dt.date | None] | None) -> DataFrame:
    return rows if months is None else in_partitions(rows, MONTH, months)


def create_status_view(lake: Lake) -> None:
    if not lake.in_catalog:
        return
    lake.create_schema(STATUS_VIEW)
    query = gold.order_status_view(
        lake.view_name("silver_orders"), lake.view_name("silver_order_items")
    )
    lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.view_name(STATUS_VIEW)} AS {query}")


def order_statuses(lake: Lake) -> DataFrame:
    return gold.order_statuses(lake.read("silver_orders"), lake.read("silver_order_items"))


def publish_dim_order(lake: Lake) -> None:
    """Order headers with their status as a table, for consumers that cannot use the view."""
    orders = contract(lake.read("silver_orders"), "silver_orders")
    lake.publish(DIM_ORDER, gold.dim_order(orders, order_statuses(lake)))


def refresh_gold(lake: Lake, months: list[dt.date | None] = (), dimensions: bool = True) -> None:
    """Bring Gold up to date after changes to orders or lines.

    Changes that `absorb` noted come with their orders: the lines of these orders are taken
    out of the fact and the marts as they were and put in as they are. Further `months`, and
    those in which renamed products were sold, are computed anew, the weekly mart for the
    months in which weeks that overlap them start; everything else stays as it is. Notes are
    removed at the end: a refresh that was cut short is made up for by the next. With
    `dimensions` these are written anew; it may be off if customers and products did not
    change.
    """
    built = (FACT, DIM_CUSTOMER, DIM_PRODUCT, DAILY, WEEKLY, MONTHLY)
    if not all(lake.exists(t) for t in built):
        run_gold(lake)
        return
    lake.recover(*BRONZE_OF, FACT, DAILY, WEEKLY, MONTHLY)
    finish_moves(lake)
    stale = lake.notes("months")
    products = lake.read("silver_products")
    if dimensions:
        renamed = _renamed_months(lake, products)
        if renamed:
            # The old names are gone once the dimension is published: note the months before.
            content = _stale_months(renamed)
            stale[lake.note("months", content)] = content
        lake.publish(DIM_CUSTOMER, gold.dim_customer(lake.read("silver_customers")))
        lake.publish(DIM_PRODUCT, gold.dim_product(products))
    create_status_view(lake)
    by_order = {m for note in stale.values() if note["orders"] for m in _months_in(note)}
    whole = {m for note in stale.values() if not note["orders"] for m in _months_in(note)}
    whole |= set(months) - by_order
    if whole:
        _refresh_months(lake, ordered(whole), products)
    if by_order - whole:
        kept = [note["orders"] for note in stale.values() if note["orders"]]
        _refresh_orders(lake, ordered(by_order - whole), kept, products)
    _forget_stale(lake, stale)


def _refresh_orders(lake: Lake, months: list[dt.date | None], kept: list[str], products: DataFrame) -> None:
    """Take changed orders over into the fact and the marts of these months, all tables or none."""
    with Scratch(lake.spark) as scratch:
        ids = lake.spark.read.parquet(*[lake.kept_path(k) for k in kept]).distinct()
        # In their order the ids take a third of the bytes, so that three times as many are broadcast.
        changed = scratch.stage(ids.sortWithinPartitions("order_id"), "changed-orders")
        read = lambda table: in_partitions(lake.read(table), MONTH, months)
        of_changed = lambda df: df.join(changed, "order_id", "left_semi")
        new = gold.fact_order_items(of_changed(read("silver_order_items")), of_changed(read("silver_orders")), products)
        new = scratch.stage(new, "new-lines")
        lines = scratch.stage(deltas.signed(of_changed(read(FACT)), new), "signed-lines")
        touched = partition_values(deltas.net(lines), MONTH)
        if not touched:
            return
        # Lines that stay lie in their months already: they are written anew from there, unless their months have come
        # to many files, or the join that leaves the others out shuffles them anyway.
        as_they_lie = broadcasts(changed) and not crowded(lake.stored_files(FACT, MONTH))
        others = F.broadcast(changed) if as_they_lie else changed
        unchanged = in_partitions(lake.read(FACT), MONTH, touched).join(others, "order_id", "left_anti")
        arrived = in_partitions(new, MONTH, touched)
        fact = unchanged.unionByName(as_stored(arrived, MONTH) if as_they_lie else arrived)
        changes = {FACT: Replacement(fact, MONTH, touched, dealt=as_they_lie)}
        by_day = scratch.stage(deltas.day_changes(lines), "day-changes")
        names = lake.read(DIM_PRODUCT)
        fit = gold.names_fit(names)
        for table, period in ((DAILY, DAY), (WEEKLY, WEEK), (MONTHLY, MONTH_START)):
            differences = deltas.changes_of(by_day, period)
            column = gold.folder_of(period)
            folders = partition_values(differences.select(month_of(period).alias(column)), column)
            if folders:
                mart, large = in_partitions(lake.read(table), column, folders), slices_of(lake.stored_files(table, column))
                mart = deltas.merged(mart, differences, names, period, fit, large)
                sort_by = None if period == MONTH_START else period
                changes[table] = Replacement(mart, column, folders, sort_by, dealt=fit)
        lake.replace(changes)


def _refresh_months(lake: Lake, months: list[dt.date | None], products: DataFrame) -> None:
    items = in_partitions(lake.read("silver_order_items"), MONTH, months)
    orders = in_partitions(lake.read("silver_orders"), MONTH, months)
    fit = gold.names_fit(products)
    fact = gold.fact_order_items(items, orders, products, dealt=fit)
    lake.replace_partitions(FACT, fact, MONTH, months, dealt=fit)

    names = lake.read(DIM_PRODUCT)
    fit = gold.names_fit(names)
    fact = in_partitions(lake.read(FACT), MONTH, months)
    by_day = gold.stored_mart_daily(fact, names, fit)
    lake.replace_partitions(DAILY, by_day, MONTH, months, sort_by=DAY, dealt=fit)
    daily, large = lake.read(DAILY), slices_of(lake.stored_files(DAILY, MONTH))
    monthly = gold.stored_roll_up(in_partitions(daily, MONTH, months), names, MONTH_START, fit, large)
    lake.replace_partitions(MONTHLY, monthly, MONTH_START, months, dealt=fit)

    # Whole months of weeks are replaced, hence the days of all weeks that start in them.
    undated: list[dt.date | None] = [None] if None in months else []
    starts = months_of(weeks_of_months([m for m in months if m is not None]))
    needed = sorted({*starts, *[next_month(m) for m in starts]})
    days = in_partitions(daily, MONTH, needed + undated)
    weekly = gold.stored_roll_up(days, names, WEEK, fit, large)
    weekly = in_partitions(weekly, MONTH, starts + undated)
    lake.replace_partitions(WEEKLY, weekly, MONTH, starts + undated, sort_by=WEEK, dealt=fit)


def _renamed_months(lake: Lake, products: DataFrame) -> list[dt.date | None]:
    """Months in which products with changed names were sold."""
    old = lake.read(DIM_PRODUCT).select(*PRODUCT_COLUMNS)
    new = products.select(*PRODUCT_COLUMNS)
    known = old.select("product_id")
    renamed = new.join(known, "product_id", "left_semi").exceptAll(old).select("product_id")
    if renamed.isEmpty():
        return []
    return partition_values(lake.read(FACT).join(renamed, "product_id", "left_semi"), MONTH)
