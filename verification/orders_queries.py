"""Queries of the sales-orders domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.measures import mean, rounded, total
from millrace.operators.audit import duplicate_keys, rule_counts
from millrace.operators.checks import check_nulls as null_checks
from millrace.operators.clean import keep_one, require, to_int
from millrace.operators.dims import hot_keys, lookup_hot
from millrace.operators.reports import top
from millrace.operators.rules import Rule
from millrace.operators.summaries import Summary, summarise
from millrace.plans import orders
from verification import loaded
from verification.duckdb_tables import davg, dsum, from_orders, hround
from verification.registry import query
from verification.stand_ins import customers, products, raw_orders

# --- audit


@query(
    from_orders(
        """select 'orders' as table_name, count(*) as rows,
                  count(distinct order_id) + cast(coalesce(bool_or(order_id is null), false) as int)
                      as distinct_keys,
                  rows - distinct_keys as duplicates from raw_orders
           union all
           select 'customers', count(*), count(distinct customer_id)
                  + cast(coalesce(bool_or(customer_id is null), false) as int), count(*)
                  - count(distinct customer_id)
                  - cast(coalesce(bool_or(customer_id is null), false) as int)
           from raw_orders"""
    )
)
def audit_duplicates(spark, sf_dir):
    """Of the key, and of a column that has nulls."""
    raw = raw_orders(spark, sf_dir)

    def of(key, name):
        return duplicate_keys(raw, key).withColumn("table_name", F.lit(name))

    return of("order_id", "orders").unionByName(of("customer_id", "customers"))


@query(
    from_orders(
        """select unnest([
               {'rule': 'negative_price',
                'matches': count(*) filter (where unit_price < 0)},
               {'rule': 'non_positive_quantity',
                'matches': count(*) filter (where quantity <= 0)}], recursive := true)
           from raw_orders"""
    )
)
def audit_rules_orders(spark, sf_dir):
    return rule_counts(raw_orders(spark, sf_dir), orders.AUDITED)


# --- cleaning


@query(from_orders("select * from survivors"))
def clean_dedup(spark, sf_dir):
    return keep_one(raw_orders(spark, sf_dir), [orders.KEY], orders.KEEP_ORDER)


@query(from_orders("select * from raw_orders where order_id is not null and customer_id is not null"))
def clean_not_null(spark, sf_dir):
    return require(raw_orders(spark, sf_dir), [orders.HAS_ID, orders.HAS_CUSTOMER])


@query(from_orders("select * from raw_orders where unit_price > 0 and quantity > 0"))
def clean_positive(spark, sf_dir):
    return require(raw_orders(spark, sf_dir), [orders.HAS_PRICE, orders.HAS_QUANTITY])


@query(
    from_orders(
        """select * replace (cast(trunc(customer_id) as int) as customer_id) from raw_orders
           where customer_id is not null"""
    )
)
def clean_cast(spark, sf_dir):
    return require(to_int(raw_orders(spark, sf_dir), "customer_id"), [orders.HAS_CUSTOMER])


@query(from_orders("select * from clean_orders"))
def clean_orders(spark, sf_dir):
    return orders.clean(raw_orders(spark, sf_dir))


@query(from_orders("select * from rejected_orders"))
def quarantine_rows(spark, sf_dir):
    return orders.rejected(raw_orders(spark, sf_dir))


# --- predicates and scalar functions


def _conditions(df, *rules: Rule):
    """What each rule's condition gives for a row: true, false or null."""
    return df.select("order_id", *(rule.column().alias(rule.name) for rule in rules))


@query(
    from_orders(
        """select order_id, unit_price < 0 as lt, quantity <= 0 as le, unit_price > 100 as gt,
                  discount_pct = 5 as eq, discount_pct <> 5 as ne from raw_orders"""
    )
)
def pred_compare(spark, sf_dir):
    return _conditions(
        raw_orders(spark, sf_dir),
        Rule("lt", "unit_price < 0"),
        Rule("le", "quantity <= 0"),
        Rule("gt", "unit_price > 100"),
        Rule("eq", "discount_pct = 5"),
        Rule("ne", "discount_pct <> 5"),
    )


@query(
    from_orders(
        """select order_id, unit_price > 0 and quantity > 0 as both_positive,
                  unit_price < 0 or quantity <= 0 as either_bad from raw_orders"""
    )
)
def pred_bool(spark, sf_dir):
    return _conditions(
        raw_orders(spark, sf_dir),
        Rule("both_positive", "unit_price > 0 and quantity > 0"),
        Rule("either_bad", "unit_price < 0 or quantity <= 0"),
    )


@query(
    from_orders(
        """select order_id, customer_id is null as no_customer, unit_price is not null as has_price
           from raw_orders"""
    )
)
def pred_null(spark, sf_dir):
    return _conditions(
        raw_orders(spark, sf_dir),
        Rule("no_customer", "customer_id is null"),
        Rule("has_price", "unit_price is not null"),
    )


@query(from_orders("select * from raw_orders where status = 'Completed'"))
def pred_status(spark, sf_dir):
    return require(raw_orders(spark, sf_dir), [Rule("completed", orders.COMPLETED)])


@query(
    from_orders(
        f"""select order_id, {hround("unit_price / 7", 0)} as round_0,
                   {hround("unit_price / 7", 1)} as round_1,
                   {hround("unit_price / 7", 2)} as round_2 from raw_orders"""
    )
)
def fn_round(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "order_id", *(F.expr(rounded("unit_price / 7", n)).alias(f"round_{n}") for n in (0, 1, 2))
    )


@query(
    from_orders(
        """select order_id, unit_price + quantity as plus, unit_price - discount_pct as minus,
                  unit_price * quantity as times, unit_price / nullif(quantity, 0) as divided,
                  unit_price * discount_pct / 100 as percent_of from raw_orders"""
    )
)
def fn_arith(spark, sf_dir):
    price, quantity, discount = F.col("unit_price"), F.col("quantity"), F.col("discount_pct")
    return raw_orders(spark, sf_dir).select(
        "order_id",
        (price + quantity).alias("plus"),
        (price - discount).alias("minus"),
        (price * quantity).alias("times"),
        F.try_divide(price, quantity).alias("divided"),
        (price * discount / 100).alias("percent_of"),
    )


@query(
    from_orders(
        """select order_id, cast(year(order_date) as int) as y, cast(month(order_date) as int) as m,
                  cast(quarter(order_date) as int) as q,
                  cast(dayofweek(order_date) + 1 as int) as dow,
                  cast(hour(order_date) as int) as h from raw_orders"""
    )
)
def fn_date_parts(spark, sf_dir):
    return orders.add_calendar(raw_orders(spark, sf_dir)).selectExpr(
        "order_id",
        "order_year as y",
        "order_month as m",
        "order_quarter as q",
        "order_day_of_week as dow",
        "order_hour as h",
    )


@query(from_orders("select order_id, cast(order_date as date) as order_day from raw_orders"))
def fn_to_date(spark, sf_dir):
    return raw_orders(spark, sf_dir).select("order_id", F.expr(orders.DAILY.keys["date"]).alias("order_day"))


@query(
    from_orders(
        """select order_id, case when unit_price < 50 then 'low' when unit_price < 500 then 'mid'
                  else 'high or unknown' end as price_band,
                  case when status = 'Completed' then 1 end as done from raw_orders"""
    )
)
def fn_case(spark, sf_dir):
    """With and without an else branch; a null price takes the else branch."""
    price = F.col("unit_price")
    return raw_orders(spark, sf_dir).select(
        "order_id",
        F.when(price < 50, "low")
        .when(price < 500, "mid")
        .otherwise("high or unknown")
        .alias("price_band"),
        F.when(F.col("status") == "Completed", 1).alias("done"),
    )


@query(
    from_orders(
        """select order_id as id, cast(order_date as date) as order_day,
                  quantity * unit_price as amount from raw_orders"""
    )
)
def project_columns(spark, sf_dir):
    return (
        raw_orders(spark, sf_dir)
        .withColumn("amount", F.col("quantity") * F.col("unit_price"))
        .select(
            F.col("order_id").alias("id"), F.to_date("order_date").alias("order_day"), "amount"
        )
    )


# --- enrichment and joins


@query(from_orders("select * from enriched"))
def enrich_orders(spark, sf_dir):
    return orders.enrich(orders.clean(raw_orders(spark, sf_dir)))


@query(from_orders("select order_id, net_revenue, revenue_bucket from enriched"))
def enrich_bucket_orders(spark, sf_dir):
    with_net = orders.add_revenue(orders.clean(raw_orders(spark, sf_dir)))
    return orders.add_revenue_bucket(with_net).select("order_id", "net_revenue", "revenue_bucket")


@query(
    from_orders(
        "select order_id, cost_price, unit_profit, total_profit, profit_margin_pct from orders_fact"
    )
)
def enrich_profit(spark, sf_dir):
    joined = orders.with_products(orders.clean(raw_orders(spark, sf_dir)), products(spark, sf_dir))
    return orders.add_profit(joined).select(
        "order_id", "cost_price", "unit_profit", "total_profit", "profit_margin_pct"
    )


@query(
    from_orders(
        """select o.*, p.product_name, p.category, p.brand, p.cost_price, p.is_active
           from clean_orders o left join products p on o.product_id = p.product_id"""
    )
)
def join_products(spark, sf_dir):
    return orders.with_products(orders.clean(raw_orders(spark, sf_dir)), products(spark, sf_dir))


@query(
    from_orders(
        """select o.*, c.customer_name, c.city, c.country, c.customer_segment
           from clean_orders o left join customers c on o.customer_id = c.customer_id"""
    )
)
def join_customers(spark, sf_dir):
    return orders.with_customers(orders.clean(raw_orders(spark, sf_dir)), customers(spark, sf_dir))


@query(
    from_orders(
        """select o.*, c.customer_name, c.city, c.country, c.customer_segment
           from raw_orders o left join customers c on o.customer_id = c.customer_id"""
    )
)
def join_hot_keys(spark, sf_dir):
    """Raw lines, with missing customers, beside their customer; keys found hot are salted."""
    raw = raw_orders(spark, sf_dir)
    hot = hot_keys(raw, "customer_id", share=0.001)
    by_double = customers(spark, sf_dir).withColumn("customer_id", F.col("customer_id").cast("double"))
    return lookup_hot(raw, by_double, "customer_id", orders.CUSTOMER_COLUMNS, hot)


@query(from_orders("select * from orders_fact"))
def fact_orders(spark, sf_dir):
    return orders.fact(
        raw_orders(spark, sf_dir), products(spark, sf_dir), customers(spark, sf_dir)
    )


@query(
    from_orders(
        """select 'products' as dimension, count(*) as orphan_rows,
                  count(distinct o.product_id) as orphan_keys
           from clean_orders o left join products p on o.product_id = p.product_id
           where p.product_id is null
           union all
           select 'customers', count(*), count(distinct o.customer_id)
           from clean_orders o left join customers c on o.customer_id = c.customer_id
           where c.customer_id is null"""
    )
)
def check_orphans(spark, sf_dir):
    return orders.orphan_report(
        loaded.fact_orders(spark, sf_dir), products(spark, sf_dir), customers(spark, sf_dir)
    )


# --- aggregates over the loaded fact


@query(from_orders("select * from agg_daily_orders"))
def agg_daily_orders(spark, sf_dir):
    return summarise(loaded.fact_orders(spark, sf_dir), orders.DAILY)


@query(from_orders("select * from agg_category_orders"))
def agg_category_month(spark, sf_dir):
    return summarise(loaded.fact_orders(spark, sf_dir), orders.CATEGORY_MONTH)


@query(
    from_orders(
        """select status, count(*) as rows, count(unit_price) as priced,
                  count(customer_id) as with_customer from raw_orders group by status"""
    )
)
def agg_count_col(spark, sf_dir):
    spec = Summary(
        keys={"status": "status"},
        measures={
            "rows": "count(*)",
            "priced": "count(unit_price)",
            "with_customer": "count(customer_id)",
        },
    )
    return summarise(raw_orders(spark, sf_dir), spec)


@query(
    from_orders(
        f"""select brand, {dsum("net_revenue")} as revenue,
                   {hround(dsum("net_revenue"), 0)} as revenue_rounded,
                   {davg("net_revenue")} as avg_revenue,
                   {hround(davg("profit_margin_pct", 1), 1)} as avg_margin
            from orders_fact group by brand"""
    )
)
def agg_sum_avg(spark, sf_dir):
    spec = Summary(
        keys={"brand": "brand"},
        measures={
            "revenue": total("net_revenue"),
            "revenue_rounded": rounded(total("net_revenue"), 0),
            "avg_revenue": mean("net_revenue"),
            "avg_margin": rounded(mean("profit_margin_pct", 1), 1),
        },
    )
    return summarise(loaded.fact_orders(spark, sf_dir), spec)


@query(
    from_orders(
        """select category, count(distinct customer_id) as customers,
                  count(distinct product_id) as products from orders_fact group by category"""
    )
)
def agg_count_distinct(spark, sf_dir):
    spec = Summary(
        keys={"category": "category"},
        measures={
            "customers": "count(distinct customer_id)",
            "products": "count(distinct product_id)",
        },
    )
    return summarise(loaded.fact_orders(spark, sf_dir), spec)


@query(
    from_orders(
        """select order_year, order_month, count(*) filter (where is_weekend) as weekend_orders,
                  count(*) filter (where net_revenue >= 500) as large_orders
           from orders_fact group by order_year, order_month"""
    )
)
def agg_conditional(spark, sf_dir):
    spec = Summary(
        keys={"order_year": "order_year", "order_month": "order_month"},
        measures={
            "weekend_orders": "count_if(is_weekend)",
            "large_orders": "count_if(net_revenue >= 500)",
        },
    )
    return summarise(loaded.fact_orders(spark, sf_dir), spec)


@query(
    from_orders(
        "select distinct status, payment_method, order_year, order_month from orders_fact"
    )
)
def agg_distinct(spark, sf_dir):
    return (
        loaded.fact_orders(spark, sf_dir)
        .select("status", "payment_method", "order_year", "order_month")
        .distinct()
    )


# --- reports


@query(
    from_orders(
        f"""select order_year, order_month, count(*) as orders,
                   {hround(dsum("net_revenue"), 0)} as revenue,
                   {hround(dsum("total_profit"), 0)} as profit,
                   {hround(davg("profit_margin_pct", 1), 1)} as avg_margin
            from orders_fact where status = 'Completed'
            group by order_year, order_month"""
    )
)
def sql_monthly_revenue(spark, sf_dir):
    return orders.report("monthly_revenue", loaded.fact_orders(spark, sf_dir))


@query(
    from_orders(
        f"""select category, count(*) as orders, {hround(dsum("net_revenue"), 0)} as revenue,
                   {hround(dsum("total_profit"), 0)} as profit,
                   {hround(davg("profit_margin_pct", 1), 1)} as avg_margin
            from orders_fact where status = 'Completed'
            group by category"""
    )
)
def sql_top_categories(spark, sf_dir):
    return orders.report("top_categories", loaded.fact_orders(spark, sf_dir))


@query(
    from_orders(
        f"""select customer_segment, count(distinct customer_id) as customers,
                   count(*) as orders, {hround(dsum("net_revenue"), 0)} as revenue,
                   {hround(f'{dsum("net_revenue")} / nullif(count(distinct customer_id), 0)', 2)}
                       as revenue_per_customer
            from orders_fact where status = 'Completed' group by customer_segment"""
    )
)
def sql_segment(spark, sf_dir):
    return orders.report("segment", loaded.fact_orders(spark, sf_dir))


@query(
    from_orders(
        f"""select revenue_bucket, count(*) as orders,
                   {hround(dsum("net_revenue"), 0)} as total_revenue,
                   {hround(davg("net_revenue"), 2)} as avg_order_value
            from orders_fact where status = 'Completed' group by revenue_bucket"""
    )
)
def sql_order_size(spark, sf_dir):
    return orders.report("order_size", loaded.fact_orders(spark, sf_dir))


# --- sorts and limits


@query(
    from_orders(
        """select order_id, order_date, customer_id, net_revenue from orders_fact
           order by net_revenue desc, order_id"""
    )
)
def sort_total(spark, sf_dir):
    return (
        loaded.fact_orders(spark, sf_dir)
        .select("order_id", "order_date", "customer_id", "net_revenue")
        .orderBy(F.desc("net_revenue"), "order_id")
    )


@query(
    from_orders(
        """select order_id, customer_name, category, net_revenue from orders_fact
           order by net_revenue desc, order_id limit 10"""
    )
)
def topk(spark, sf_dir):
    fact = loaded.fact_orders(spark, sf_dir)
    columns = fact.select("order_id", "customer_name", "category", "net_revenue")
    return top(columns, 10, F.desc("net_revenue"), "order_id")


@query(
    from_orders(
        """select order_id, customer_name, product_name, category, quantity, net_revenue,
                  total_profit, customer_segment from orders_fact order by order_id limit 5"""
    )
)
def sample_rows(spark, sf_dir):
    fact = loaded.fact_orders(spark, sf_dir)
    columns = fact.select(
        "order_id",
        "customer_name",
        "product_name",
        "category",
        "quantity",
        "net_revenue",
        "total_profit",
        "customer_segment",
    )
    return top(columns, 5, "order_id")


# --- checks

_VERDICT = "case when failures = 0 then 'PASS' else 'FAIL' end as verdict"


@query(from_orders(f"""select *, {_VERDICT} from order_checks where "check" like 'null_%'"""))
def check_nulls(spark, sf_dir):
    return null_checks(loaded.fact_orders(spark, sf_dir), orders.REQUIRED_OUTPUT)


@query(from_orders(f"select *, {_VERDICT} from order_checks"))
def check_orders(spark, sf_dir):
    return orders.checks(loaded.fact_orders(spark, sf_dir))
