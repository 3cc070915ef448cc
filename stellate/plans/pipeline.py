"""The whole load, in dependency order (calendar, dimensions, bridge, fact).

Each load merges its source into the published table -- type 1, 2, 3 or 4 --
so surrogate keys, versions and previous values survive from one run to the
next.  Every table is written as a new snapshot and audited by what the
registry declares for it.  Later steps read these written tables, so each
step's lineage is cut at shared storage: a lost executor recomputes at most
the current step, never the whole chain.  When all are written, references
between tables included, one manifest makes the whole star current; a load
that fails anywhere leaves the star of the day before.

Lines that lack a key wait in ``fact_rejects`` with their source values and
are tried again by each load whose dimensions have changed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators import audit
from stellate.operators.append import new_rows
from stellate.operators.calendar import calendar_from_bounds
from stellate.operators.merge import scd1_load
from stellate.operators.scd import scd2_load, scd3_load, scd4_load
from stellate.plans import star
from stellate.sources import catalog
from stellate.sources import testdata as td
from stellate.sources.commit import Commit, Pinned, pin
from stellate.sources.publish import Snapshot, checkpoint_table, current_snapshot, prepare, read_snapshot, switch, warehouse_root

FACT_KEY = ["order_id", "line_number", "product_key", "employee_key"]
#: what identifies a loaded line: its source values, no version keys
LINE_KEY = ["order_id", "line_number", "ship_date_key", "quantity", "line_price", "discount"]
LOOKUPS = ["customer_key", "shipper_key", "product_key", "employee_key"]


@dataclass(frozen=True)
class Dimension:
    """How a source is merged into its published dimension."""

    kind: str
    key: str
    sk: str
    tracked: tuple
    null_mode: str
    extra: str = ""  # target-only columns


VERSION = "is_current boolean, effective_date date, ineffective_date date"
DIMENSIONS = {
    "dim_customers": Dimension("scd3", "c_custkey", "customer_key", ("c_name", "c_nationkey", "c_mktsegment"), "sql",
                               "c_mktsegment_prev string, c_mktsegment_prev_validto string"),
    "dim_products": Dimension("scd4", "product_id", "product_key",
                              ("product_name", "brand", "size", "unit_price", "category_name"), "null_safe", "valid_from date"),
    "dim_employees": Dimension("scd2", "employee_id", "employee_key",
                               ("last_name", "nation_id", "acctbal", "photo", "reports_to"), "sentinel", VERSION),
    "dim_territories": Dimension("scd2", "territory_id", "territory_key", ("description", "region_id"), "sentinel", VERSION),
    "dim_regions": Dimension("scd2", "region_id", "region_key", ("description",), "sentinel", VERSION),
    "dim_shippers": Dimension("scd1", "shipper_id", "shipper_key", ("company_name",), "sentinel"),
}
PREVIOUS = {"c_mktsegment": ("c_mktsegment_prev", "c_mktsegment_prev_validto")}


def date_bounds(spark, sf_dir) -> DataFrame:
    o = td.table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("start_date"),
                                              F.max(F.to_date("o_orderdate")).alias("end_date"))
    li = td.table(spark, sf_dir, "lineitem").agg(F.min(F.to_date("l_shipdate")).alias("start_date"),
                                                 F.max(F.to_date("l_shipdate")).alias("end_date"))
    return o.unionByName(li).agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))


def _empty(source: DataFrame, d: Dimension) -> DataFrame:
    spark = source.sparkSession
    extra = spark.createDataFrame([], f"{d.extra + ', ' if d.extra else ''}{d.sk} bigint").schema
    return spark.createDataFrame([], type(extra)(source.schema.fields + extra.fields))


def prepare_dimension(spark: SparkSession, name: str, source: DataFrame, as_of, base: Snapshot | None, root: str) -> dict[str, tuple]:
    """Arguments of ``prepare`` for the dimension ``name`` (and its history)
    after merging ``source``, the whole source, into the snapshot ``base``.  New rows and new
    versions get surrogate keys above the largest one, all others keep theirs."""
    d = DIMENSIONS[name]
    target = read_snapshot(spark, name, base, root) if base else _empty(source, d)
    checks = audit.declared(catalog.REGISTRY[name], {})
    checks["source_key"] = lambda _w: audit.duplicate_keys(source, d.key)
    how = {"feed_keys": (d.key,)}
    if d.kind == "scd2":
        # versions that were closed before stay in their folders
        out, feed = scd2_load(target, source, d.key, d.tracked, as_of, d.null_mode, sk_col=d.sk, with_closed=False)
        return {name: (out, checks, {**how, "feed": feed, "keep": base, "flag": "is_current"})}
    if d.kind == "scd1":
        out, feed = scd1_load(target, source, d.key, list(d.tracked), d.null_mode, delete_missing=True, sk_col=d.sk)
    elif d.kind == "scd3":
        out, feed = scd3_load(target, source, d.key, d.tracked, PREVIOUS, as_of, d.null_mode, sk_col=d.sk)
    else:
        out, feed, replaced = scd4_load(target, source, d.key, d.tracked, as_of, d.null_mode, sk_col=d.sk)
        return {name: (out, checks, {**how, "feed": feed}), f"{name}_history": (replaced, None, {})}
    return {name: (out, checks, {**how, "feed": feed})}


def _with_history(spark, name: str, rows: DataFrame, base: Snapshot | None, root: str) -> tuple:
    """Replaced images appended to the history; a rerun adds nothing."""
    add = new_rows(rows, read_snapshot(spark, name, base, root), ["product_id", "valid_from"]) if base else rows
    return add, audit.declared(catalog.REGISTRY[name], {}), {"keep": base}


def load_dimension(spark: SparkSession, name: str, source: DataFrame, as_of, root: str | None = None,
                   commit: Commit | None = None) -> int:
    """Merge ``source`` into the dimension ``name``: within a ``commit``, or
    published by itself.  Returns the dimension's version."""
    root = root or (commit.root if commit else warehouse_root(spark))
    before = commit.before if commit else (lambda table: current_snapshot(spark, table, root))
    base = before(name)
    version = 0
    for table, (out, checks, how) in prepare_dimension(spark, name, source, as_of, base, root).items():
        own = base if table == name else before(table)
        if table != name:
            out, checks, how = _with_history(spark, table, out, own, root)
        if commit:
            made = commit.prepare(out, table, checks, **how).version
        else:
            made = switch(spark, table, root, prepare(out, table, checks, root, **how), own)
        version = made if table == name else version
    return version


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"]
#: the dimension that gives each looked-up key
KEY_OF = dict(zip(LOOKUPS, ("dim_customers", "dim_shippers", "dim_products", "dim_employees")))


def load_fact(spark: SparkSession, sf_dir: str, lines: DataFrame, commit: Commit) -> dict:
    """Look up a batch of order lines in the commit's dimensions (current rows)
    and append the lines that the fact doesn't have yet.

    Lines without a match go to ``fact_rejects``: their source values, the
    missing keys, and the dimension snapshots that were tried.  A line that
    waits there is looked up again, once, when a dimension that it misses has
    another snapshot, and becomes a fact row when nothing is missing any more.
    A waiting line that the batch delivers again is the batch's."""
    root = commit.root
    tables = {n: commit.table(n) for n in ("dim_date", *DIMENSIONS)}
    # the lookups need current versions alone: one partition of the newest folder
    dims = {"customers": tables["dim_customers"], "products": tables["dim_products"], "shippers": tables["dim_shippers"],
            "employees": commit.table("dim_employees", open_only=True)}
    now = {c: _state_of(commit, KEY_OF[c]) for c in LOOKUPS}
    tried = F.create_map(*[x for c in LOOKUPS for x in (F.lit(c), F.lit(now[c]))])
    batch, waiting = lines.select(*LINE_COLS), None
    old = commit.before("fact_rejects")
    if old is not None:
        pending = read_snapshot(spark, "fact_rejects", old, root)
        pending = pending.select(F.col("line.*"), "missing", "tried")
        # a waiting line that is delivered again is looked up as part of the batch; what is left is read twice, so it is staged
        pending = checkpoint_table(new_rows(pending, batch, LINE_COLS, "l_shipdate"), "star-pending")
        changed = F.exists(F.split("missing", ","), lambda c: ~F.col("tried")[c].eqNullSafe(tried[c]))
        waiting = pending.filter(~changed)
        batch = batch.unionByName(pending.filter(changed).select(*LINE_COLS))
    complete = " AND ".join(f"{c} IS NOT NULL" for c in LOOKUPS)
    # the batch is looked up once: the fact, the comparison with what is loaded and the rejects read it staged
    looked_up = star.fact_order_lines(spark, sf_dir, dims, batch, how="left", keep_lines=True)
    looked_up = checkpoint_table(looked_up.withColumn("line", F.when(F.expr(f"NOT ({complete})"), F.col("line"))), "star-looked-up")
    add = looked_up.filter(complete).drop("line").withColumn("ship_year", (F.col("ship_date_key") / 10000).cast("int"))
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in LOOKUPS])), ",")
    rejects = looked_up.filter(f"NOT ({complete})").select(
        "order_id", "line_number", missing.alias("missing"), "line", tried.alias("tried"))
    if waiting is not None:
        rejects = rejects.unionByName(waiting.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("bigint").alias("line_number"), "missing",
            F.struct(*LINE_COLS).alias("line"), "tried"))
    base = commit.before("fact_order_lines")
    if base:  # folders are partitioned by the year of the key's date, so only the batch's years are read
        add = new_rows(add, read_snapshot(spark, "fact_order_lines", base, root), ["ship_year", *LINE_KEY], "ship_year")
    checks = audit.declared(catalog.REGISTRY["fact_order_lines"], tables)
    return {"fact_order_lines": commit.prepare(add, "fact_order_lines", checks, partition_by=["ship_year"], keep=base).version,
            "fact_rejects": commit.prepare(rejects, "fact_rejects").version}


def _state_of(commit: Commit, table: str) -> str:
    """Names the rows that a dimension offers to lookups: another load of equal rows has another name."""
    snap = commit.prepared.get(table) or commit.before(table)
    return snap.head


STAR = "star"


def read_star(spark: SparkSession, root: str | None = None, version: int | None = None) -> Pinned:
    """The newest whole star, or the given version, pinned."""
    return pin(spark, STAR, root, version)


def run_star(spark: SparkSession, sf_dir: str, root: str | None = None, parallel: int = 6, day: int | None = None,
             as_of=td.AS_OF, lines: DataFrame | None = None, checks=None) -> dict:
    """Load the star and make it current as a whole.  Returns ``{table: version}``.

    ``day`` picks the sources (see ``testdata.star_sources``), ``as_of`` is
    the load's date, ``lines`` the fact's batch (default: all order lines).
    Loads without a dependency between them run as concurrent Spark jobs
    (``parallel`` threads submitting jobs): first the calendar and the
    dimensions, then the bridge and the fact, which read the dimensions as
    this load leaves them.  Each table is audited when it is written;
    ``checks(commit)`` may give further audits over all of them (name ->
    DataFrame of violations).  Only then one manifest makes all current; the
    first failure is raised once its wave has finished, and nothing changes.
    """
    commit = Commit(spark, STAR, root)
    sources = td.star_sources(spark, sf_dir, day)
    lines = lines if lines is not None else td.table(spark, sf_dir, "lineitem")

    def wave(jobs: dict) -> dict:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as ex:
            futures = {name: ex.submit(job) for name, job in jobs.items()}
            return {name: f.result() for name, f in futures.items()}

    def dates() -> int:
        return commit.prepare(calendar_from_bounds(date_bounds(spark, sf_dir)), "dim_date",
                              audit.declared(catalog.REGISTRY["dim_date"], {})).version

    def bridge() -> int:
        dims = {n: commit.table(n) for n in ("dim_employees", "dim_territories")}
        current = [commit.table(n, open_only=True) for n in ("dim_employees", "dim_territories")]
        return commit.prepare(star.bridge_employee_territory(spark, sf_dir, *current), "bridge_employee_territory",
                              audit.declared(catalog.REGISTRY["bridge_employee_territory"], dims)).version

    snaps = wave({"dim_date": dates, **{n: (lambda n=n: load_dimension(spark, n, sources[n], as_of, commit=commit)) for n in DIMENSIONS}})
    second = wave({"bridge_employee_territory": bridge, "fact": lambda: load_fact(spark, sf_dir, lines, commit)})
    if checks is not None:
        commit.audit(checks(commit))
    commit.commit()
    return {**snaps, "bridge_employee_territory": second["bridge_employee_territory"], **second["fact"]}


SUMMARY_KEYS = {
    "dim_customers": ["customer_key"], "dim_products": ["product_key"], "dim_employees": ["employee_key"],
    "dim_shippers": ["shipper_key"], "dim_territories": ["territory_key"], "dim_regions": ["region_key"],
    "bridge_employee_territory": ["employee_key", "territory_key"], "dim_date": ["date_key"],
    "fact_order_lines": FACT_KEY,
}


def summary(spark: SparkSession, root: str | None = None, version: int | None = None) -> DataFrame:
    """Rows and distinct keys of every star table."""
    tables, parts = read_star(spark, root, version), []
    for name, keys in SUMMARY_KEYS.items():
        df = tables.table(name)
        parts.append(df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                            F.count_distinct(*[F.col(k) for k in keys]).cast("bigint").alias("n_keys"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "n_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: columns of each table in the content listing
CONTENT = {
    "dim_customers": ["customer_key", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_mktsegment_prev",
                      "c_mktsegment_prev_validto"],
    "dim_products": ["product_key", "product_id", "product_name", "brand", "size", "unit_price", "category_name", "valid_from"],
    "dim_products_history": ["product_key", "product_id", "product_name", "unit_price", "valid_from", "valid_to"],
    "dim_employees": ["employee_key", "employee_id", "last_name", "nation_id", "acctbal", "photo", "reports_to", "is_current",
                      "effective_date", "ineffective_date"],
    "dim_territories": ["territory_key", "territory_id", "description", "region_id", "is_current", "effective_date",
                        "ineffective_date"],
    "dim_regions": ["region_key", "region_id", "description", "is_current", "effective_date", "ineffective_date"],
    "dim_shippers": ["shipper_key", "shipper_id", "company_name"],
    "bridge_employee_territory": ["employee_key", "territory_key"],
    "fact_order_lines": ["order_id", "line_number", "customer_key", "employee_key", "product_key", "shipper_key", "order_date_key",
                         "ship_date_key", "quantity", "line_price", "list_price", "discount"],
    "fact_rejects": ["order_id", "line_number", "missing"],
}


def content(spark: SparkSession, root: str | None = None, version: int | None = None) -> DataFrame:
    """Every row of every star table as text: ``table_name, row_text``."""
    tables, parts = read_star(spark, root, version), []
    for name, cols in CONTENT.items():
        df = tables.table(name)

        def text(c, types=dict(df.dtypes)):
            v = F.hex(c) if types[c] == "binary" else F.col(c).cast("decimal(19,4)") if types[c] == "double" else F.col(c)
            return F.coalesce(v.cast("string"), F.lit("~"))
        parts.append(df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[text(c) for c in cols]).alias("row_text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
