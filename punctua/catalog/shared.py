"""Jobs that share tables or run for ever: the commit log, streams that keep tables up to date, alerts."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.catalog import derived
from punctua.catalog.core import _plain
from punctua.catalog.derived import fact_sql
from punctua.catalog.registry import SQL, Tables, query
from punctua.plans.fact import FACT_COLUMNS
from punctua.session import shared_dir, shuffles_freed
from punctua.sources import CommitLog, GateFailed, drop_namespace, load_shared, publish, read_published, read_seed, read_table_or_export, run_loads
from punctua.streaming import fact_of, fold_fact, open_fact, refresh_batch, start_refresh, start_throttle, watch_silence, write_batch

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _landed(t: Tables, seen: Column) -> DataFrame:
    return t.orders.where(seen).select(
        F.when(F.col("o_orderstatus") == "F", F.lit("<html>")).otherwise(F.concat(F.lit('{"data": ['), F.col("o_orderkey").cast("string"), F.lit("]}"))).alias("raw_data"),
        F.concat(F.lit("raw/"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("source_file"))


@query("concurrent_load", """
select 'raw/' || o_orderkey || '.json' as source_file, count(*) as copies, case when o_orderstatus = 'F' then 'LOAD_FAILED' else 'LOADED' end as status
from orders group by all""")
def concurrent_load(t: Tables) -> DataFrame:
    """A2, K5. Two loaders see overlapping files and have both written before either commits; a third is killed before its commit and run again."""
    log, met = CommitLog(t.spark, shared_dir(t.spark, "shared")), threading.Barrier(2, timeout=600)
    places = {"even": F.col("o_orderkey") % 3 != 0, "odd": F.col("o_orderkey") % 3 != 1}
    failed: list[Exception] = []

    def run(name: str) -> None:
        waited = []

        def meet() -> None:
            if not waited:
                waited.append(met.wait())

        try:
            load_shared(_landed(t, places[name]), log, name, 0, before_commit=meet)
        except Exception as error:  # noqa: BLE001 - raised below, in the caller's thread
            failed.append(error)

    threads = [threading.Thread(target=run, args=(n,)) for n in places]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    if failed:
        raise failed[0]

    def killed() -> None:
        raise KeyboardInterrupt

    everything = _landed(t, F.lit(True))
    try:
        load_shared(everything, log, "third", 0, before_commit=killed)
    except KeyboardInterrupt:
        pass
    for batch in (0, 0):  # the second run is a replay
        load_shared(everything, log, "third", batch)
    return log.snapshot().read("raw").groupBy("source_file", "status").agg(F.count(F.lit(1)).alias("copies"))


@query("publish_gated", "select o_orderstatus, count(*) as rows, sum(o_totalprice)::double as total from orders group by 1")
def publish_gated(t: Tables) -> DataFrame:
    """A9, C9, H22. A table is replaced only if the metrics seen while it was written pass; a later faulty version leaves it as it is."""
    log = CommitLog(t.spark, shared_dir(t.spark, "published"))
    metrics = {"rows": F.count(F.lit(1)), "negative": F.count_if(F.col("o_totalprice") < 0), "undated": F.count_if(F.col("o_orderdate").isNull())}
    expected = t.orders.count()

    def gate(found: dict) -> list[str]:
        wrong = [f"{n} {found[n]}" for n in ("negative", "undated") if found[n]]
        return wrong + ([f"{found['rows']} rows, expected {expected}"] if found["rows"] != expected else [])

    log.publish(t.orders, "orders", metrics, gate)
    for faulty in (t.orders.where("o_orderkey % 7 <> 0"), t.orders.withColumn("o_totalprice", -F.col("o_totalprice"))):
        try:
            log.publish(faulty, "orders", metrics, gate)
        except GateFailed:
            continue
        raise AssertionError("a faulty table was published")
    return log.snapshot().read("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").cast("double").alias("total"))


@query("stream_refresh", fact_sql(f"select {', '.join(FACT_COLUMNS)} from fact"))
def stream_refresh(t: Tables) -> DataFrame:
    """K3. The fact kept up by two streams of late files, with a replayed batch; equals the fact of all files."""
    flights, weather, dim = derived.flights_table(t), derived.weather_table(t), derived.airports(t)
    root = shared_dir(t.spark, "refreshed")
    log, part = CommitLog(t.spark, f"{root}/tables"), F.crc32(F.col("source_file").cast("binary")) % 10
    drops = [("flights", flights, part == 0), ("weather", weather, part <= 1), ("flights", flights, (part == 1) | (part == 2))]
    with shuffles_freed(t.spark):
        open_fact(log, flights.where(part > 2), weather.where(part > 1), dim)
        for i, (kind, rows, late) in enumerate(drops):
            write_batch(rows.where(late), i, f"{root}/landing/{kind}")
            stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/landing/{kind}/*")
            start_refresh(stream, log, kind, kind, f"{root}/checkpoint/{kind}", dim).awaitTermination()
        if refresh_batch(log, "flights", flights.where(part == 0), "flights", 0, dim):
            raise AssertionError("a replayed batch was taken again")
        fold_fact(log)
    return _plain(fact_of(log))


_LIMIT, _SINCE = 12, "2023-12-31 12:00:00"


@query("stream_silence", f"""
with expected as (select distinct user_id from events where user_id is not null union select -1 union select -2),
points as (select user_id, timestamp '{_SINCE}' as ts from expected union all select user_id, ts from events where user_id is not null and ts is not null),
gaps as (select *, lead(ts) over (partition by user_id order by ts) as nxt from points)
select user_id, 'silent' as kind, ts + interval {_LIMIT} hour as at, ts as last_heard from gaps where nxt is null or nxt > ts + interval {_LIMIT} hour
union all select user_id, 'recovered', nxt, ts from gaps where nxt > ts + interval {_LIMIT} hour""")
def stream_silence(t: Tables) -> DataFrame:
    """J2, J3. Members that are not heard for 12 hours, some of them never, and when they are heard again."""
    root, seen = shared_dir(t.spark, "silence"), t.events.select("user_id", "ts")
    expected = seen.where("user_id is not null").select("user_id").union(t.spark.range(-2, 0).toDF("user_id")).distinct().withColumn("since", F.lit(_SINCE).cast("timestamp"))
    first, last = seen.agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    portions = [seen.where(F.col("ts") < first + third), seen.where((F.col("ts") >= first + third) & (F.col("ts") < first + 2 * third)), seen.where(F.col("ts") >= first + 2 * third)]
    ahead = t.spark.createDataFrame([(None, last + 3 * (last - first))], seen.schema)  # time goes on after the last row
    before = t.spark.conf.get(_STORE)
    t.spark.conf.set(_STORE, _ROCKS)
    try:
        for i, rows in enumerate([*portions, ahead]):
            write_batch(rows, i, f"{root}/landing")
            said = watch_silence(t.spark.readStream.schema(seen.schema).parquet(f"{root}/landing/*"), expected, "user_id", "ts", "since", _LIMIT, "2 hours")
            (said.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out")
             .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    finally:
        t.spark.conf.set(_STORE, before)
    return t.spark.read.parquet(f"{root}/out").where("user_id is not null")


@query("stream_throttle", SQL["alert_throttle"])
def stream_throttle(t: Tables) -> DataFrame:
    """J6. ``alert_throttle`` as a stream: results arrive in three portions, announcements and state are committed together."""
    from punctua.catalog.reporting import check_results

    root, results = shared_dir(t.spark, "throttle"), check_results(t)
    log, schema = CommitLog(t.spark, f"{root}/tables"), results.schema
    first, last = t.events.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first + (last - first) * k / 3 for k in (1, 2)]
    at = F.col("checked_at")
    for i, rows in enumerate([results.where(at < cuts[0]), results.where((at >= cuts[0]) & (at < cuts[1])), results.where(at >= cuts[1])]):
        write_batch(rows, i, f"{root}/landing")
        stream = t.spark.readStream.schema(schema).parquet(f"{root}/landing/*")
        start_throttle(stream, log, "results", f"{root}/checkpoint").awaitTermination()
    return log.snapshot().read("alerts")


@query("export_fallback", """
select o_orderkey, o_orderstatus, o_orderdate::timestamp as ordered_at, c_nationkey, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""")
def export_fallback(t: Tables) -> DataFrame:
    """A8, A10. Orders from a typed export, because their table is not there, scoped by a seed."""
    root = shared_dir(t.spark, "exports")
    named = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_orderstatus").alias("O_ORDERSTATUS"), F.col("o_orderdate").cast("timestamp_ntz").alias("ORDERED_AT"),
        F.col("c_nationkey").alias("C_NATIONKEY"))
    named.write.csv(f"{root}/orders", header=True)
    t.nation.select("n_nationkey", "n_name").write.csv(f"{root}/nations", header=True)
    seed = read_seed(t.spark, f"{root}/nations", "n_nationkey BIGINT, n_name STRING")
    orders = read_table_or_export(t.spark, lambda: t.spark.read.parquet(f"{root}/no-such-table"), f"{root}/orders",
                                  "O_ORDERKEY BIGINT, O_ORDERSTATUS STRING, ORDERED_AT STRING, C_NATIONKEY BIGINT")
    return orders.join(seed, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "o_orderstatus", "ordered_at", "c_nationkey", "n_name")


@query("published_namespaces", """
select 'orders' as table_name, count(*) as rows from orders where o_orderkey % 2 = 0 union all select 'customer', count(*) from customer""")
def published_namespaces(t: Tables) -> DataFrame:
    """A5, A9, A12. Independent loads publish two tables, one of them twice; the throwaway namespace can be dropped, the main one cannot."""
    root = shared_dir(t.spark, "warehouse")
    even = t.orders.where("o_orderkey % 2 = 0")
    loads = {"orders": lambda: [publish(df, root, "orders") for df in (t.orders, even)], "customer": lambda: publish(t.customer, root, "customer"),
             "throwaway": lambda: publish(t.customer.where(F.lit(False)), root, "customer", "ci")}
    run_loads(loads)
    if drop_namespace(t.spark, root, "main") or not drop_namespace(t.spark, root, "ci"):
        raise AssertionError("only the throwaway namespace may be dropped")
    parts = [read_published(t.spark, root, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in ("orders", "customer")]
    return parts[0].unionByName(parts[1])
