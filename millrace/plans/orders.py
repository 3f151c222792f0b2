"""Sales orders: raw orders, products and customers to a star schema."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import mergeable
from millrace.functions.columns import bucket, flag
from millrace.functions.measures import mean, ratio, rounded, total
from millrace.operators.audit import rule_counts
from millrace.operators.checks import check_rules, check_unique, gate, null_rules
from millrace.operators.clean import COPIES, collapse, keep_one, require, step_counts, to_int
from millrace.operators.dims import lookup, orphan_counts, require_unique
from millrace.operators.judge import kept_rows, one_each, rejected_rows, rows_as_read, write_judged
from millrace.operators.reports import Report
from millrace.operators.rules import ALL_ROWS, Rule
from millrace.operators.summaries import Summary, summarise
from millrace.plans.runlog import ALTERED, StageClock, logged_failure, reload_log, run_log
from millrace.plans.survivors import Fact, fold, merge_summaries, range_of_keys, write_states, write_survivors
from millrace.session import fresh_dir, scratch_scope
from millrace.sources import versions
from millrace.sources.readers import read_parquet
from millrace.sources.schemas import CORRUPT_RECORD, RAW_ORDERS
from millrace.sources.versions import Draft
from millrace.sources.writers import (
    append_json,
    at_once,
    spread,
    verify_partitions,
    verify_tables,
    write_partitioned,
    write_tables,
)

FACT = "fact_orders"
REJECTED_TABLE = "rejected_orders"
RELOAD = "orders_reload"
KEY = "order_id"
# Which of several rows with one order_id stays: the least in this order.
KEEP_ORDER = (
    "order_date",
    "customer_id",
    "product_id",
    "quantity",
    "unit_price",
    "discount_pct",
    "payment_method",
    "status",
)
PARTITIONED_BY = ("order_year", "order_month")

# Column lists, labels and edges of the output tables.
PRODUCT_COLUMNS = ("product_name", "category", "brand", "cost_price", "is_active")
CUSTOMER_COLUMNS = ("customer_name", "city", "country", "customer_segment")
PROFIT_COLUMNS = ("unit_profit", "total_profit", "profit_margin_pct")
REVENUE_EDGES = (50, 200, 500)
REVENUE_LABELS = ("Small (<$50)", "Medium ($50-200)", "Large ($200-500)", "Enterprise ($500+)")
WEEKEND_DAYS = (1, 7)
REQUIRED_OUTPUT = ("order_id", "customer_id", "product_id", "net_revenue", "category")

READABLE = Rule("cell_unreadable", f"{CORRUPT_RECORD} is null")
HAS_ID = Rule("order_id_missing", "order_id is not null")
HAS_PRICE = Rule("unit_price_not_positive", "unit_price > 0 and unit_price < double('Infinity')")
HAS_QUANTITY = Rule("quantity_not_positive", "quantity > 0")
# On the raw column and on the cast one alike.
HAS_CUSTOMER = Rule("customer_id_missing", "try_cast(customer_id as int) is not null")
NOT_SURPLUS = Rule("order_id_repeated", "not is_surplus")
RULES = (HAS_ID, NOT_SURPLUS, HAS_PRICE, HAS_QUANTITY, HAS_CUSTOMER)

AUDITED = (
    Rule("negative_price", "unit_price < 0"),
    Rule("non_positive_quantity", "quantity <= 0"),
)

NEGATIVE_REVENUE = Rule("negative_revenue", "net_revenue < 0")
# Sums leave such values out, so they must not pass unseen.
ODD_REVENUE = Rule("non_finite_revenue", "isnan(net_revenue) or abs(net_revenue) = double('Infinity')")
ODD_PROFIT = Rule("non_finite_profit", "isnan(total_profit) or abs(total_profit) = double('Infinity')")

COMPLETED = "status = 'Completed'"

DAILY = Summary(
    keys={"date": "to_date(order_date)"},
    where=COMPLETED,
    measures={
        "total_orders": mergeable.count("order_id"),
        "total_revenue": mergeable.total("net_revenue"),
        "total_profit": mergeable.total("total_profit"),
        "avg_order_value": mergeable.mean("net_revenue"),
        "unique_customers": mergeable.distinct("customer_id"),
        "weekend_orders": mergeable.count_if("is_weekend"),
    },
)

# The month is not qualified by the year, so years add up; ``DAILY`` keeps them.
CATEGORY_MONTH = Summary(
    keys={"category": "category", "order_month": "order_month"},
    where=COMPLETED,
    measures={
        "orders": mergeable.count("order_id"),
        "revenue": mergeable.total("net_revenue"),
        "profit": mergeable.total("total_profit"),
        "avg_margin": mergeable.mean("profit_margin_pct", 1),
        "unique_customers": mergeable.distinct("customer_id"),
    },
)

SUMMARIES = {"agg_daily_summary": DAILY, "agg_category_summary": CATEGORY_MONTH}

VIEW = "orders_fact"
_REVENUE = rounded(total("net_revenue"), 0)
_PROFIT = rounded(total("total_profit"), 0)
_MARGIN = rounded(mean("profit_margin_pct", 1), 1)

REPORTS = {
    "monthly_revenue": Report(
        VIEW,
        f"""
        select order_year, order_month, count(*) as orders, {_REVENUE} as revenue,
               {_PROFIT} as profit, {_MARGIN} as avg_margin
        from {VIEW} where {COMPLETED}
        group by order_year, order_month order by order_year, order_month
        """,
    ),
    "top_categories": Report(
        VIEW,
        f"""
        select category, count(*) as orders, {_REVENUE} as revenue,
               {_PROFIT} as profit, {_MARGIN} as avg_margin
        from {VIEW} where {COMPLETED}
        group by category order by profit desc, category
        """,
    ),
    "segment": Report(
        VIEW,
        f"""
        select customer_segment, count(distinct customer_id) as customers,
               count(*) as orders, {_REVENUE} as revenue,
               {rounded(ratio(total("net_revenue"), "count(distinct customer_id)"), 2)}
                   as revenue_per_customer
        from {VIEW} where {COMPLETED}
        group by customer_segment order by revenue_per_customer desc, customer_segment
        """,
    ),
    "order_size": Report(
        VIEW,
        f"""
        select revenue_bucket, count(*) as orders, {_REVENUE} as total_revenue,
               {rounded(mean("net_revenue"), 2)} as avg_order_value
        from {VIEW} where {COMPLETED}
        group by revenue_bucket order by avg_order_value, revenue_bucket
        """,
    ),
}


def readable(raw: DataFrame) -> DataFrame:
    """Rows without an unreadable cell, and without the column that marks them."""
    if CORRUPT_RECORD not in raw.columns:
        return raw
    return raw.filter(READABLE.column()).drop(CORRUPT_RECORD)


def clean(raw: DataFrame) -> DataFrame:
    """One row per order, then only rows with an id, a price, a quantity and a customer.

    Lines with an unreadable cell, where the reader kept their text, are set aside
    before anything else: what their other cells hold is not to be trusted. Then
    comes deduplication, so an invalid row that is kept for its key takes its valid
    twins with it.
    """
    return valid(keep_one(readable(raw), [KEY], KEEP_ORDER))


def valid(rows: DataFrame) -> DataFrame:
    """Rows with an id, a price, a quantity and a customer; the customer as a whole number."""
    priced = require(rows, [HAS_ID, HAS_PRICE, HAS_QUANTITY])
    return require(to_int(priced, "customer_id"), [HAS_CUSTOMER])


def judge(raw: DataFrame, path: str | None = None) -> DataFrame:
    """Every raw row with what cleaning makes of it, written to the scratch folder; see `judge`."""
    spark = raw.sparkSession
    return write_judged(
        raw,
        RULES,
        path or fresh_dir(spark, "judged-orders"),
        keys=[KEY],
        order_by=KEEP_ORDER,
        readable=READABLE if CORRUPT_RECORD in raw.columns else None,
        scratch=fresh_dir(spark, "repeated-orders"),
    )


def cleaned_of(judged: DataFrame) -> DataFrame:
    """What ``clean`` gives, from judged rows."""
    rows = to_int(kept_rows(judged), "customer_id")
    return rows.drop(CORRUPT_RECORD)


def rejected_of(judged: DataFrame) -> DataFrame:
    """Every raw row that ``clean`` drops, with the reason. Types as in ``clean``."""
    return to_int(rejected_rows(judged), "customer_id")


def rejected(raw: DataFrame) -> DataFrame:
    return rejected_of(judge(raw))


def steps_of(judged: DataFrame) -> DataFrame:
    """Row counts through the steps of ``clean``, from judged rows."""
    return step_counts(one_each(judged), [HAS_ID, HAS_PRICE, HAS_QUANTITY, HAS_CUSTOMER], COPIES)


def clean_steps(raw: DataFrame) -> DataFrame:
    """As ``steps_of``, in one go: rows of one key are merged per task, and nothing is written."""
    one_row = collapse(readable(raw), [KEY], KEEP_ORDER)
    return step_counts(one_row, [HAS_ID, HAS_PRICE, HAS_QUANTITY, HAS_CUSTOMER], COPIES)


def add_revenue(df: DataFrame) -> DataFrame:
    gross = df.withColumn("gross_revenue", F.round(F.col("quantity") * F.col("unit_price"), 2))
    # Later amounts build on the rounded earlier ones.
    discount = F.round(F.col("gross_revenue") * F.col("discount_pct") / 100, 2)
    return gross.withColumn("discount_amount", discount).withColumn(
        "net_revenue", F.round(F.col("gross_revenue") - F.col("discount_amount"), 2)
    )


def add_calendar(df: DataFrame) -> DataFrame:
    day = F.dayofweek("order_date")
    return df.withColumns(
        {
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_quarter": F.quarter("order_date"),
            "order_day_of_week": day,
            "is_weekend": flag(day.isin(*WEEKEND_DAYS)),
            "order_hour": F.hour("order_date"),
        }
    )


def add_revenue_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue_bucket", bucket("net_revenue", REVENUE_EDGES, REVENUE_LABELS))


def enrich(cleaned: DataFrame) -> DataFrame:
    """Ten columns that need no dimension."""
    return add_revenue_bucket(add_calendar(add_revenue(cleaned)))


def add_profit(df: DataFrame) -> DataFrame:
    """Profit before discount; null where the product is unknown."""
    unit = df.withColumn("unit_profit", F.round(F.col("unit_price") - F.col("cost_price"), 2))
    margin = F.try_divide("unit_profit", "unit_price") * 100
    return unit.withColumns(
        {
            "total_profit": F.round(F.col("unit_profit") * F.col("quantity"), 2),
            "profit_margin_pct": F.round(margin, 1),
        }
    )


def with_products(df: DataFrame, products: DataFrame) -> DataFrame:
    return lookup(df, products, "product_id", PRODUCT_COLUMNS)


def with_customers(df: DataFrame, customers: DataFrame) -> DataFrame:
    return lookup(df, customers, "customer_id", CUSTOMER_COLUMNS)


def with_dimensions(cleaned: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Cleaned rows with the columns of both dimensions and nothing derived yet.

    A join that shuffles then carries narrow rows; customers, the larger dimension, come first.
    """
    rows = cleaned.select(*RAW_ORDERS.fieldNames())  # whatever else the source has
    return with_products(with_customers(rows, customers), products)


def complete(joined: DataFrame) -> DataFrame:
    """The 31 columns of the fact table, from rows joined to both dimensions; no shuffle."""
    built = add_profit(enrich(joined))
    keys = ["customer_id", "product_id"]
    raw = [c for c in RAW_ORDERS.fieldNames() if c not in keys]
    looked_up = [*PRODUCT_COLUMNS, *CUSTOMER_COLUMNS]
    derived = [c for c in built.columns if c not in {*keys, *raw, *looked_up, *PROFIT_COLUMNS}]
    return built.select(*keys, *raw, *derived, *looked_up, *PROFIT_COLUMNS)


def build_fact(cleaned: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The 31 columns of the fact table. Dimension keys have to be unique."""
    return complete(with_dimensions(cleaned, products, customers))


def fact(raw: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    return build_fact(clean(raw), products, customers)


def placed_in(rows: DataFrame) -> DataFrame:
    """Rows with the fact's partition columns."""
    return rows.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})


def spread_fact(cleaned: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The fact, spread to its partitions as joined rows, before derived columns make them wider."""
    return complete(spread(placed_in(with_dimensions(cleaned, products, customers)), *PARTITIONED_BY))


def write_fact(
    raw: DataFrame, products: DataFrame, customers: DataFrame, path: str
) -> DataFrame:
    """Write the fact and read it back.

    Rows are spread over the output partitions once, after the joins, so the plan and
    the layout of the files are the same for dimensions of any size. What is derived from a
    row alone is added after that, on its way to the files.
    """
    built = spread_fact(clean(raw), products, customers)
    write_partitioned(built, path, PARTITIONED_BY, already_spread=True)
    return read_parquet(raw.sparkSession, path, schema=built.schema)


def orphan_report(fact_rows: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Fact rows without a product or without a customer."""
    return orphan_counts(fact_rows, products, "product_id", "products").unionByName(
        orphan_counts(fact_rows, customers, "customer_id", "customers")
    )


def checks(fact_rows: DataFrame) -> DataFrame:
    """All checks on the fact table, each of which counts for the verdict."""
    return check_rules(fact_rows, [*null_rules(REQUIRED_OUTPUT), NEGATIVE_REVENUE, ODD_REVENUE, ODD_PROFIT]).unionByName(
        check_unique(fact_rows, KEY, "duplicate_orders")
    )


def fact_table(products: DataFrame, customers: DataFrame) -> Fact:
    """What a reload of the fact goes by."""
    return Fact(
        table=FACT,
        key=KEY,
        order_by=KEEP_ORDER,
        by=PARTITIONED_BY,
        placed=lambda rows: add_calendar(valid(rows)),
        join=lambda rows: placed_in(with_dimensions(rows, products, customers)),
        complete=complete,
        summaries=SUMMARIES,
    )


TABLES = (FACT, "dim_products", "dim_customers", *SUMMARIES)


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the star schema that are live below ``root``."""
    manifest = versions.live(spark, root)
    schemas = {FACT: T.StructType.fromJson(manifest.facts["fact_schema"])} if manifest else {}
    return {name: versions.read(spark, root, name, schemas.get(name), manifest) for name in TABLES}


def run(
    spark: SparkSession,
    raw: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    root: str,
    quarantine: bool = False,
    reloadable: bool = False,
    publish_failed: bool = False,
) -> DataFrame:
    """Load the star schema below ``root`` and return the run's log, one row.

    Raw rows are judged in one pass, and everything else reads what that wrote. The fact is
    computed once, on its way to disk. Summaries, checks and counts read the written tables, so
    they also prove that these are readable, and compare them with what went out. Only then
    does the new version become visible, unless a check fails and ``publish_failed`` is not set:
    the tables before it stay live then, as they do when the run dies anywhere.

    ``reloadable`` also keeps survivors and states of the summaries, for `reload`. The counts in
    the log are aggregates over tables.
    """
    clock = StageClock()
    with logged_failure(spark, "orders", clock, root), scratch_scope(spark):
        draft = Draft(spark, root)
        sources = {"orders_raw": raw, "products_raw": products, "customers_raw": customers}
        dimension_rows = at_once(
            {
                "products_raw": lambda: require_unique(products, "product_id"),
                "customers_raw": lambda: require_unique(customers, "customer_id"),
            }
        )
        clock.end("extract")
        judged_at = fresh_dir(spark, "judged-orders")
        judged = judge(raw, judged_at)
        make = spread_fact if reloadable else build_fact
        built = make(cleaned_of(judged), products, customers)
        written = {FACT: write_partitioned(built, draft.path(FACT), PARTITIONED_BY, already_spread=reloadable)}
        loaded = versions.read_folders(spark, root, FACT, [draft.folder(FACT)], built.schema)
        clock.end("transform")

        spec = fact_table(products, customers)
        others = {"dim_products": products, "dim_customers": customers}
        if quarantine:
            others[REJECTED_TABLE] = rejected_of(judged)
        kept = {"fact_schema": json.loads(built.schema.json())}
        folders = {name: [draft.folder(name)] for name in (*TABLES, *others)}
        if reloadable:
            once = one_each(judged.filter(HAS_ID.column())).drop(CORRUPT_RECORD)
            kept["survivor_width"] = range_of_keys(once, KEY)
            write_survivors(once, spec, draft.path(spec.survivors), *kept["survivor_width"])
            schemas = write_states(loaded, spec, draft)
            folders |= {name: [draft.folder(name)] for name in (spec.survivors, *schemas)}
            others |= merge_summaries(spark, root, spec, folders, schemas)
        else:
            others |= {name: summarise(loaded, summary) for name, summary in SUMMARIES.items()}
        went_out = write_tables({draft.path(name): df for name, df in others.items()})
        written |= {name: went_out[draft.path(name)] for name in others}
        clock.end("load")

        back = {name: versions.read_folders(spark, root, name, folders[name]) for name in others}
        back[FACT] = loaded
        # A few rows each: the only data that comes to the driver.
        counted = at_once(
            {
                "audit": rule_counts(rows_as_read(raw, judged_at), [ALL_ROWS, *AUDITED]).collect,
                "steps": steps_of(judged).collect,
                "tables": verify_tables(back, written).collect,
                "partitions": verify_partitions(loaded, PARTITIONED_BY).first,
                "checks": checks(loaded).collect,
            }
        )
        audit = {r["rule"]: r["matches"] for r in counted["audit"]}
        raw_rows = audit.pop(ALL_ROWS.name)
        found = {r["table"]: r for r in counted["tables"]}
        failures = {r["check"]: r["failures"] for r in counted["checks"]}
        failures[ALTERED] = sum(not r["intact"] for r in found.values())
        clock.end("checks")
        passed = not any(failures.values())
        publish = passed or publish_failed
        log = run_log(
            spark,
            name="orders",
            failures=failures,
            sources=sources,
            extract={"orders_raw": raw_rows, **dimension_rows},
            issues=audit,
            steps=counted["steps"],
            last_cleaning_step=HAS_CUSTOMER.name,
            rows_final=found[FACT]["rows"],
            columns_before=len(RAW_ORDERS),
            clock=clock,
            fact_path=draft.path(FACT),
            summaries=list(SUMMARIES),
            final_columns=found[FACT]["columns"],
            loaded={f"{name}_rows": found[name]["rows"] for name in TABLES},
            partition_columns=PARTITIONED_BY,
            partitions=counted["partitions"]["partitions"],
            root=root,
            version=draft.number,
            published=publish,
        )
        if publish:
            draft.publish(folders, written=written, **kept)
    append_json(log, f"{root}/run_log")
    return log


def reload(
    spark: SparkSession,
    batch: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    root: str,
    publish_failed: bool = False,
) -> DataFrame:
    """Fold new raw rows into what a ``reloadable`` run or a reload left; returns the log.

    Fact, summaries and survivors become what a full load of all raw rows gives, with two
    limits: rows that are not touched keep what the dimensions held when they were built, and
    the table of rejected rows stays that of the last full run. Only partitions that change are
    checked. Run again after a failure; a batch that was taken in before changes nothing.
    """
    clock = StageClock()
    with logged_failure(spark, RELOAD, clock, root), scratch_scope(spark):
        draft = Draft(spark, root)
        live = draft.before
        if live is None or "survivor_width" not in live.facts:
            raise versions.NothingPublished(f"no version with survivors at {root}")
        spec = fact_table(products, customers)
        rows = readable(batch).select(*RAW_ORDERS.fieldNames())
        made = fold(spark, root, live, rows, spec, draft, lambda name: fresh_dir(spark, name))
        clock.end("load")
        failures = {r["check"]: r["failures"] for r in checks(made.rows).collect()} if made.partitions else {}
        clock.end("checks")
        publish = publish_failed or not any(failures.values())
        log = reload_log(
            spark,
            name=RELOAD,
            failures=failures,
            sources={"batch": batch},
            loaded={"changed_keys": made.keys, "partitions_rewritten": made.partitions},
            clock=clock,
            root=root,
            version=draft.number,
            published=publish,
        )
        if publish:
            same = {k: v for k, v in live.facts["written"].items() if list(live.tables[k]) == made.tables[k]}
            draft.publish(made.tables, **{**live.facts, "written": same})
    append_json(log, f"{root}/run_log")
    return log


def report(name: str, fact_rows: DataFrame) -> DataFrame:
    return REPORTS[name].run(fact_rows)


def verdict(fact_rows: DataFrame) -> DataFrame:
    return gate(checks(fact_rows))


