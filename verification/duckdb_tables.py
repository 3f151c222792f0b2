"""The same tables and steps as CTEs for DuckDB, written independently of the library."""

from __future__ import annotations


def hround(x: str, n: int) -> str:
    """Half-up rounding of the decimal text of a double, as Spark rounds."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,20)), {n}) as double)"


def dsum(x: str, scale: int = 2) -> str:
    return f"cast(sum(cast({x} as decimal({18 if scale <= 2 else 28},{scale}))) as double)"


def davg(x: str, scale: int = 2) -> str:
    return f"({dsum(x, scale)} / nullif(count({x}), 0))"


def pct(part: str, whole: str, n: int) -> str:
    return hround(f"(100.0::double * {part} / nullif({whole}, 0))", n)


_ORDER_BY = """order_date, customer_id nulls first, product_id, quantity, unit_price nulls first,
    discount_pct, payment_method, status"""

ORDERS = f"""
raw0 as (
  select l_orderkey * 10 + l_linenumber as order_id,
         o_orderdate + to_hours(cast(l_linenumber * 3 as int)) as order_date,
         case when l_orderkey % 50 = 0 then null when l_orderkey % 97 = 5 then -1.0::double * o_custkey
              else cast(o_custkey as double) end as customer_id,
         case when l_orderkey % 101 = 7 then -l_partkey else l_partkey end as product_id,
         case when l_suppkey % 37 = 0 then 0 else cast(l_quantity as int) end as quantity,
         case when (l_orderkey + l_partkey) % 33 = 0 then null
              when (l_orderkey + l_suppkey) % 997 = 0 then -l_extendedprice
              when l_partkey % 5 = 0 then l_extendedprice / 10000
              else l_extendedprice / 100 end as unit_price,
         cast(floor(l_discount * 100 + 0.5) as int) as discount_pct,
         o_orderpriority as payment_method,
         case when l_returnflag = 'R' and l_suppkey % 2 = 0 then 'Returned'
              when l_suppkey % 19 = 1 then 'Cancelled'
              when l_suppkey % 23 = 2 then 'Pending'
              else 'Completed' end as status
  from lineitem join orders on l_orderkey = o_orderkey),
raw_orders as (
  select * from raw0 union all select * from raw0 where order_id % 2500 = 1),
products as (
  select p_partkey as product_id, p_name as product_name, p_type as category,
         p_brand as brand, p_retailprice / 2 as cost_price, p_size % 20 <> 0 as is_active,
         p_size / 10.0::double as weight_kg
  from part),
customers as (
  select cast(c_custkey as int) as customer_id, c_name as customer_name,
         case when c_nationkey % 3 = 0 then 'North' when c_nationkey % 3 = 1 then 'South'
              else 'West' end as city,
         case when c_nationkey < 15 then 'USA' else 'India' end as country,
         c_mktsegment as customer_segment,
         case when c_custkey % 13 = 0 then null else 'c' || c_custkey || '@example.com' end as email,
         cast(date '2019-01-01' + cast(c_custkey % 1500 as int) as date) as signup_date
  from customer),
ranked as (
  select *, row_number() over (partition by order_id order by {_ORDER_BY}) as rn
  from raw_orders),
survivors as (select * exclude (rn) from ranked where rn = 1),
clean_orders as (
  select * replace (cast(trunc(customer_id) as int) as customer_id) from survivors
  where order_id is not null and unit_price > 0 and quantity > 0 and customer_id is not null),
with_gross as (
  select *, {hround("quantity * unit_price", 2)} as gross_revenue from clean_orders),
with_discount as (
  select *, {hround("gross_revenue * discount_pct / 100", 2)} as discount_amount
  from with_gross),
with_net as (
  select *, {hround("gross_revenue - discount_amount", 2)} as net_revenue from with_discount),
enriched as (
  select *, cast(year(order_date) as int) as order_year,
         cast(month(order_date) as int) as order_month,
         cast(quarter(order_date) as int) as order_quarter,
         cast(dayofweek(order_date) + 1 as int) as order_day_of_week,
         dayofweek(order_date) in (0, 6) as is_weekend,
         cast(hour(order_date) as int) as order_hour,
         case when net_revenue < 50 then 'Small (<$50)'
              when net_revenue < 200 then 'Medium ($50-200)'
              when net_revenue < 500 then 'Large ($200-500)'
              else 'Enterprise ($500+)' end as revenue_bucket
  from with_net),
joined as (
  select e.*, p.product_name, p.category, p.brand, p.cost_price, p.is_active,
         c.customer_name, c.city, c.country, c.customer_segment
  from enriched e left join products p on e.product_id = p.product_id
  left join customers c on e.customer_id = c.customer_id),
with_unit as (
  select *, {hround("unit_price - cost_price", 2)} as unit_profit from joined),
orders_fact as (
  select *, {hround("unit_profit * quantity", 2)} as total_profit,
         {hround("unit_profit / unit_price * 100", 1)} as profit_margin_pct
  from with_unit),
agg_daily_orders as (
  select cast(order_date as date) as date, count(order_id) as total_orders,
         {dsum("net_revenue")} as total_revenue, {dsum("total_profit")} as total_profit,
         {davg("net_revenue")} as avg_order_value,
         count(distinct customer_id) as unique_customers,
         count(*) filter (where is_weekend) as weekend_orders
  from orders_fact where status = 'Completed' group by 1),
agg_category_orders as (
  select category, order_month, count(order_id) as orders, {dsum("net_revenue")} as revenue,
         {dsum("total_profit")} as profit, {davg("profit_margin_pct", 1)} as avg_margin,
         count(distinct customer_id) as unique_customers
  from orders_fact where status = 'Completed' group by category, order_month),
judged_orders as (
  select * exclude (rn) replace (cast(trunc(customer_id) as int) as customer_id),
         case when order_id is null then 'order_id_missing'
              when rn > 1 then 'order_id_repeated'
              when unit_price is null or unit_price <= 0 then 'unit_price_not_positive'
              when quantity is null or quantity <= 0 then 'quantity_not_positive'
              when customer_id is null then 'customer_id_missing' end as reason
  from ranked),
rejected_orders as (select * from judged_orders where reason is not null),
order_checks as (
  select unnest([
      {{'check': 'null_order_id', 'failures': count(*) filter (where order_id is null)}},
      {{'check': 'null_customer_id', 'failures': count(*) filter (where customer_id is null)}},
      {{'check': 'null_product_id', 'failures': count(*) filter (where product_id is null)}},
      {{'check': 'null_net_revenue', 'failures': count(*) filter (where net_revenue is null)}},
      {{'check': 'null_category', 'failures': count(*) filter (where category is null)}},
      {{'check': 'negative_revenue', 'failures': count(*) filter (where net_revenue < 0)}},
      {{'check': 'non_finite_revenue', 'failures': count(*) filter (where not isfinite(net_revenue))}},
      {{'check': 'non_finite_profit', 'failures': count(*) filter (where not isfinite(total_profit))}},
      {{'check': 'duplicate_orders', 'failures': count(*) - count(distinct order_id)}}
    ], recursive := true)
  from orders_fact)
"""

_SECONDS = "(cast(floor(epoch({})) as bigint))"
_ELAPSED = (
    f"({_SECONDS.format('tpep_dropoff_datetime')} - {_SECONDS.format('tpep_pickup_datetime')})"
)
_VALID = """fare_amount > 0 and fare_amount < 500 and trip_distance > 0 and trip_distance < 200
    and total_amount > 0 and total_amount < 500 and passenger_count > 0 and passenger_count <= 6
    and year(tpep_pickup_datetime) = 2024 and tpep_pickup_datetime < tpep_dropoff_datetime"""

FARE = hround(davg("fare_amount", 6), 2)
DISTANCE = hround(davg("trip_distance", 6), 2)
DURATION = hround(davg("trip_duration_min", 1), 1)
SPEED = hround(davg("speed_mph", 1), 1)
TIP_PCT = hround(davg("tip_pct", 1), 1)
REVENUE = hround(dsum("total_amount", 6), 0)

TRIPS = f"""
e as (
  select event_id, user_id, value, ts,
         lead(ts) over (partition by user_id order by ts, event_id) as next_ts,
         cast(json_extract_string(props, '$.k') as int) as k,
         cast(case when event_id % 61 = 0 then -400 else (event_id % 3) * 31 end as int)
             as shift_days
  from events),
raw_trips as (
  select event_id, cast(1 + event_id % 2 as int) as VendorID,
         ts + to_days(shift_days) as tpep_pickup_datetime,
         next_ts + to_days(shift_days) as tpep_dropoff_datetime,
         case when event_id % 41 = 0 then null else event_id % 8 end as passenger_count,
         k / 5.0::double as trip_distance,
         1 + event_id % 6 as RatecodeID,
         100 + user_id % 60 as PULocationID,
         100 + event_id % 60 as DOLocationID,
         event_id % 6 as payment_type,
         case when event_id % 53 = 0 then -value when event_id % 71 = 0 then 0.0::double
              else value end as fare_amount,
         case when event_id % 97 = 0 then -1.0::double
              else value * (event_id % 30) / 100.0::double end as tip_amount,
         value * 1.5::double as total_amount
  from e),
metrics as (
  select *, {hround(f"{_ELAPSED} / 60.0::double", 1)} as trip_duration_min,
         case when {_ELAPSED} > 60
              then {hround(f"trip_distance / ({_ELAPSED} / 3600.0::double)", 1)} end as speed_mph,
         case when fare_amount > 0 then {hround("tip_amount / fare_amount * 100", 1)}
              else 0.0::double end as tip_pct,
         case when trip_distance > 0 then {hround("fare_amount / trip_distance", 2)} end
             as cost_per_mile
  from raw_trips),
calendar as (
  select *, cast(hour(tpep_pickup_datetime) as int) as pickup_hour,
         cast(tpep_pickup_datetime as date) as pickup_date,
         cast(month(tpep_pickup_datetime) as int) as pickup_month,
         cast(dayofweek(tpep_pickup_datetime) + 1 as int) as pickup_day_of_week,
         ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dayofweek(tpep_pickup_datetime) + 1]
             as day_name,
         case when hour(tpep_pickup_datetime) in (6, 7, 8, 9, 10, 11) then 'Morning'
              when hour(tpep_pickup_datetime) in (12, 13, 14, 15, 16) then 'Afternoon'
              when hour(tpep_pickup_datetime) in (17, 18, 19, 20, 21) then 'Evening'
              else 'Night' end as time_of_day,
         hour(tpep_pickup_datetime) in (7, 8, 9, 17, 18, 19) as is_rush_hour
  from metrics),
labelled as (
  select *, coalesce(PULocationID in (132, 138) or DOLocationID in (132, 138), false)
             as is_airport,
         case payment_type when 1 then 'Credit Card' when 2 then 'Cash' when 3 then 'No Charge'
              when 4 then 'Dispute' else 'Other' end as payment_name,
         case when fare_amount < 10 then 'Under $10' when fare_amount < 25 then '$10-25'
              when fare_amount < 50 then '$25-50' when fare_amount < 100 then '$50-100'
              else '$100+' end as fare_bucket,
         case when trip_distance < 1 then 'Under 1 mi' when trip_distance < 3 then '1-3 mi'
              when trip_distance < 5 then '3-5 mi' when trip_distance < 10 then '5-10 mi'
              else '10+ mi' end as distance_bucket
  from calendar),
clean_trips as (select * from labelled where {_VALID}),
trips_fact as (
  select * from clean_trips where trip_duration_min > 1 and trip_duration_min < 180
    and (speed_mph is null or speed_mph < 80)),
agg_daily_trips as (
  select pickup_date, count(*) as total_trips,
         {hround(dsum("fare_amount", 6), 2)} as total_fares,
         {hround(dsum("tip_amount", 6), 2)} as total_tips,
         {hround(dsum("total_amount", 6), 2)} as total_revenue,
         {FARE} as avg_fare, {DISTANCE} as avg_distance, {DURATION} as avg_duration,
         {TIP_PCT} as avg_tip_pct, {SPEED} as avg_speed,
         count(*) filter (where is_airport) as airport_trips,
         count(*) filter (where is_rush_hour) as rush_hour_trips
  from trips_fact group by pickup_date),
agg_hourly_trips as (
  select pickup_hour, time_of_day, count(*) as trips, {FARE} as avg_fare,
         {DISTANCE} as avg_distance, {SPEED} as avg_speed, {TIP_PCT} as avg_tip_pct
  from trips_fact group by pickup_hour, time_of_day),
agg_zone_trips as (
  select PULocationID, count(*) as trips, {REVENUE} as total_revenue, {FARE} as avg_fare,
         {DISTANCE} as avg_distance, {TIP_PCT} as avg_tip_pct
  from trips_fact group by PULocationID),
agg_payment_trips as (
  select payment_name, pickup_month, count(*) as trips, {REVENUE} as revenue,
         {TIP_PCT} as avg_tip_pct
  from trips_fact group by payment_name, pickup_month),
judged_trips as (
  select event_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
         trip_distance, RatecodeID, PULocationID, DOLocationID, payment_type, fare_amount,
         tip_amount, total_amount,
         case when not coalesce(fare_amount > 0 and fare_amount < 500, false)
                  then 'fare_out_of_range'
              when not coalesce(trip_distance > 0 and trip_distance < 200, false)
                  then 'distance_out_of_range'
              when not coalesce(total_amount > 0 and total_amount < 500, false)
                  then 'total_out_of_range'
              when not coalesce(passenger_count > 0 and passenger_count <= 6, false)
                  then 'passengers_out_of_range'
              when year(tpep_pickup_datetime) <> 2024 then 'outside_period'
              when not coalesce(tpep_pickup_datetime < tpep_dropoff_datetime, false)
                  then 'not_in_time_order'
              when not coalesce(trip_duration_min > 1 and trip_duration_min < 180, false)
                  then 'duration_implausible'
              when speed_mph >= 80 then 'speed_implausible' end as reason
  from metrics),
rejected_trips as (select * from judged_trips where reason is not null),
trip_checks as (
  select unnest([
      {{'check': 'negative_fares', 'failures': count(*) filter (where fare_amount < 0)}},
      {{'check': 'zero_distance', 'failures': count(*) filter (where trip_distance <= 0)}},
      {{'check': 'null_durations',
        'failures': count(*) filter (where trip_duration_min is null)}},
      {{'check': 'wrong_year',
        'failures': count(*) filter (where year(tpep_pickup_datetime) <> 2024)}}
    ], recursive := true)
  from trips_fact)
"""


def from_orders(body: str) -> str:
    return f"with {ORDERS}\n{body}"


def from_trips(body: str) -> str:
    return f"with {TRIPS}\n{body}"


def from_both(body: str) -> str:
    return f"with {ORDERS.rstrip()},{TRIPS}\n{body}"
