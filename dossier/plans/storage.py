"""Queries over sources and sinks (inventory A), with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.sources import tables as t

from .views import view


def latest_runs(spark, d):
    runs = view(spark, d, "select event_type as stage, cast(event_id as string) as run_id, ts as completed_at from {events}")
    return t.latest_run(runs)


def flat_table(spark, d):
    df = view(spark, d, "select o_custkey, o_orderkey, o_orderstatus from {orders}").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("orders"), F.array_sort(F.collect_set("o_orderstatus")).alias("statuses"))
    return t.flat_columns(df, ["o_custkey", "orders", "statuses", "note"], ",")


def stage_counts(spark, d):
    return t.stage_metrics(view(spark, d, "select event_type, user_id % 10 as u from {events}"), "events", ["event_type", "u"])


QUERIES = {"latest_runs": latest_runs, "flat_table": flat_table, "stage_counts": stage_counts}
SQL = {
    "latest_runs": "select stage, run_id from (select event_type as stage, event_id::varchar as run_id, row_number() over (partition by event_type order by ts desc, event_id::varchar desc) as k from events) where k = 1",
    "flat_table": "select o_custkey, string_agg(o_orderkey::varchar, ',' order by o_orderkey) as orders, array_to_string(list_sort(list(distinct o_orderstatus)), ',') as statuses, null::varchar as note from orders group by o_custkey",
    "stage_counts": "select 'events' as stage, event_type, user_id % 10 as u, count(*) as n from events group by all",
}
