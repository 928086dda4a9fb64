"""A deterministic transactions view over the generic ``events`` test table.

The text runs unchanged in Spark SQL and DuckDB, so the queries and their checks start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# What the categorical columns can hold.
MERCHANTS = "electronics,entertainment,fashion,food_delivery,grocery,jewelry,travel,utilities"
PAYMENTS = "credit_card,debit_card,netbanking,upi,wallet"
DEVICES = "mobile_android,mobile_ios,pos_terminal,web_chrome,web_safari"


def _one_of(values: str, number: str) -> str:
    """The value at a number that runs round the list."""
    return f"split_part('{values}', ',', cast(1 + ({number}) % {values.count(',') + 1} as int))"


# Labels are likelier for large amounts and in the hours that 5 divides, by a rule of this file.
TRANSACTIONS_SQL = f"""
select concat('TXN', cast(100000 + event_id as string)) as transaction_id,
       10000 + user_id as customer_id,
       value as amount,
       ts as transaction_time,
       {_one_of(MERCHANTS, "event_id * 3")} as merchant_category,
       {_one_of(PAYMENTS, "length(event_type) + event_id")} as payment_type,
       {_one_of(DEVICES, "k")} as device,
       8e0 + cast((event_id * 37) % 270 as double) / 10e0 as location_lat,
       68e0 + cast((event_id * 53) % 220 as double) / 10e0 as location_lon,
       case when (event_id * 7919 + k * 104729) % 1000
                 < 5 + (case when value > 120 then 60 else 0 end) + (case when h % 5 = 0 then 20 else 0 end)
            then 1 else 0 end as is_fraud
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
             cast(extract(hour from ts) as int) as h from {{events}}) e
"""

# Requests with gaps and every kind of rule violation, so that validation and defaulting have work to do.
REQUESTS_SQL = f"""
select concat('REQ', cast(event_id as string)) as request_id,
       case when event_id % 41 = 0 then null when event_id % 37 = 0 then -value
            when event_id % 43 = 0 then 0e0 else value end as amount,
       case when event_id % 11 = 0 then null when event_id % 59 = 0 then 24 else h end as hour,
       case when event_id % 13 = 0 then null when event_id % 61 = 0 then 7
            else cast(event_id % 7 as int) end as day_of_week,
       case when event_id % 17 = 0 then null when event_id % 3 = 0 then 'unlisted'
            else {_one_of(MERCHANTS, "event_id")} end as merchant_category,
       case when event_type = 'error' then null else {_one_of(PAYMENTS, "length(event_type)")} end as payment_type,
       case when k % 9 = 0 then null else {_one_of(DEVICES, "k")} end as device,
       case when event_id % 19 = 0 then null when event_id % 67 = 0 then 2
            else cast(k % 2 as int) end as new_device,
       case when k % 3 = 0 then null else cast(k % 9 as double) end as transactions_last_1h,
       case when k % 4 = 0 then null else cast(k as double) end as transactions_last_24h,
       case when k % 6 = 0 then null else 10e0 + cast(k as double) end as cust_running_avg_amount,
       case when k % 7 = 0 then null else cast(k % 10 as double) / 4e0 end as location_change
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
             cast(extract(hour from ts) as int) as h from {{events}}) e
"""


def transactions_from_events(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(TRANSACTIONS_SQL, events=events)


def requests_from_events(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(REQUESTS_SQL, events=events)
