"""Detection evaluation: J7, W2, V1-V5.

Truth comes from the days of the table: an event from 06:00 to 09:00 and a clear
interval from 12:00 to 20:00 on each of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import SQL, points, rnd
from dayprints.functions.student import t_quantile
from dayprints.functions.time import epoch_seconds
from dayprints.operators import evaluate
from dayprints.session import cut_lineage

HOUR_MS = 3_600_000


def _samples(spark, sf):
    return points(spark, sf).select("node", "ts", "event_id", "result")


def _days(spark, sf):
    midnight = (epoch_seconds(F.col("day").cast("timestamp_ntz")) * 1000).alias("midnight")
    return points(spark, sf).select("day").distinct().select("day", F.dayofmonth("day").alias("d"),
                                                             midnight)


def truth(spark, sf):
    tier = F.expr("element_at(array('leaf', 'spine', 'dr'), d % 3 + 1)")
    return _days(spark, sf).select(
        F.concat(F.lit("event"), F.col("d").cast("string")).alias("name"),
        (F.col("midnight") + 6 * HOUR_MS).alias("start_ms"),
        (F.col("midnight") + 9 * HOUR_MS).alias("end_ms"),
        F.concat(tier, (F.col("d") % 6).cast("string")).alias("node"),
        F.when(F.col("d") % 5 == 0, "multiple").otherwise("single").alias("type"),
        (F.col("d") % 2 == 0).alias("online"))


def clears(spark, sf):
    return _days(spark, sf).select(
        F.concat(F.lit("clear"), F.col("d").cast("string")).alias("name"),
        (F.col("midnight") + 12 * HOUR_MS).alias("start_ms"),
        (F.col("midnight") + 20 * HOUR_MS).alias("end_ms"))


def in_event(spark, sf):
    rows = evaluate.flagged(_samples(spark, sf))
    kept = truth(spark, sf).drop("node")
    events = evaluate.interval_join(rows, kept).select("node", "ms", "rn", "name")
    clear = evaluate.interval_join(rows, clears(spark, sf), open_start=True)
    return events.unionByName(clear.select("node", "ms", "rn", "name"))


def flag_runs(spark, sf):
    inside = evaluate.interval_join(evaluate.flagged(_samples(spark, sf)),
                                    truth(spark, sf).drop("node"))
    return evaluate.flag_runs(inside).select("node", "name", "first_rn", "first_ms", "length")


def detection(spark, sf):
    return evaluate.detection(_samples(spark, sf), truth(spark, sf))


def detections(spark, sf):
    return evaluate.detections(_samples(spark, sf), truth(spark, sf))


def detection_online(spark, sf):
    samples = _samples(spark, sf)
    rows = cut_lineage(evaluate.flagged(samples))
    return evaluate.detection(samples, truth(spark, sf), online=True, rows=rows).join(
        evaluate.false_positives(samples, clears(spark, sf), rows=rows), on=["node", "k"])


def false_positives(spark, sf):
    return evaluate.false_positives(_samples(spark, sf), clears(spark, sf))


def _rounded(df, keys):
    return df.select(*keys, *[F.coalesce(rnd(c), F.lit(-1.0)).alias(c)
                              for c in df.columns if c not in keys])


def precision_recall(spark, sf):
    samples, clear = _samples(spark, sf), clears(spark, sf)
    rows = cut_lineage(evaluate.flagged(samples))
    out = evaluate.precision_recall(evaluate.detection(samples, truth(spark, sf), rows=rows),
                                    evaluate.false_positives(samples, clear, rows=rows), clear)
    return _rounded(out, ["k"])


def delay_by_hop(spark, sf):
    return _rounded(evaluate.delay_by_hop(detections(spark, sf)), ["k", "hop"])


QUERIES = {
    "in_event": in_event,
    "flag_runs": flag_runs,
    "detection": detection,
    "detections": detections,
    "false_positives": false_positives,
    "precision_recall": precision_recall,
    "delay_by_hop": delay_by_hop,
    "detection_online": detection_online,
}

_BASE = SQL + """, days as (
      select distinct cast(day(day) as integer) as d,
        cast(epoch(cast(day as timestamp)) as bigint) * 1000 as midnight from dp),
    truth as (
      select 'event' || d as name, midnight + 6 * 3600000 as start_ms,
        midnight + 9 * 3600000 as end_ms,
        (case d % 3 when 0 then 'leaf' when 1 then 'spine' else 'dr' end) || (d % 6) as enode,
        case when d % 5 = 0 then 'multiple' else 'single' end as type, d % 2 = 0 as online
      from days),
    clears as (
      select 'clear' || d as name, midnight + 12 * 3600000 as start_ms,
        midnight + 20 * 3600000 as end_ms from days),
    nb as (
      select node, epoch_us(ts) // 1000 as ms, result,
        row_number() over (partition by node order by ts, event_id) as rn from dp),
    fl as (
      select *, rn - row_number() over (partition by node order by rn) as run
      from nb where result),
    ine as (
      select fl.*, t.name, t.start_ms, t.enode, t.type, t.online from fl
      join truth t on fl.ms >= t.start_ms and fl.ms <= t.end_ms),
    inc as (
      select fl.*, c.name from fl join clears c on fl.ms > c.start_ms and fl.ms <= c.end_ms),
    runs as (
      select node, name, run, min(rn) as first_rn, min(ms) as first_ms, count(*) as length
      from ine group by all),
    cruns as (select node, name, run, count(*) as length from inc group by all),
    pos as (
      select *, cast(rn - min(rn) over (partition by node, name, run) + 1 as integer) as k
      from ine where type = 'single'),
    tn as (select *, regexp_extract(node, '[a-z]+') as a, regexp_extract(enode, '[a-z]+') as b
      from pos where k <= 5),
    det as (
      select node, name, k, min(ms - start_ms) as delay_ms, online,
        cast(case when node = enode then 0
          when a || b in ('leafspine', 'spineleaf', 'leafdr', 'drleaf', 'drdr') then 1
          else 2 end as integer) as hop
      from tn group by all),
    nk as (select distinct node, cast(r.i as integer) as k from dp, range(1, 6) r(i)),
    fp as (
      select nk.node, nk.k, count(c.length) as false_positives
      from nk left join cruns c on c.node = nk.node and c.length >= nk.k group by all),
    dt as (
      select nk.node, nk.k, count(det.name) as detections,
        (select count(*) from truth where type = 'single') as events
      from nk left join det on det.node = nk.node and det.k = nk.k group by all),
    tq(n, q) as (values """ + ", ".join(
    f"({n}, {t_quantile(n - 1)!r}::double)" for n in range(2, 201)) + ")"


def _stats(m: str) -> str:
    return (f"round(coalesce(avg({m}), 0), 6) as {m}_mean, coalesce(round((select q from tq "
            f"where n = count({m})) * stddev_samp({m}) / sqrt(count({m})), 6), -1) as {m}_width")


ORACLES = {
    "in_event": _BASE + """ select node, ms, rn, name from ine
        union all select node, ms, rn, name from inc""",
    "flag_runs": _BASE + " select node, name, first_rn, first_ms, length from runs",
    "detection": _BASE + " select * from dt",
    "detections": _BASE + " select node, name, k, delay_ms, hop from det",
    "false_positives": _BASE + " select * from fp",
    "precision_recall": _BASE + f""", rt as (
          select k, case when events <> 0 then detections / events end as recall,
            case when detections <> 0 then detections / (detections + false_positives) end
              as precision,
            false_positives / ((select count(*) from clears) + 1) as fr
          from dt join fp using (node, k)),
        st as (select k, {_stats("recall")}, {_stats("precision")}, {_stats("fr")}
          from rt group by k)
        select k, recall_mean, recall_width, precision_mean, precision_width,
          case when k = 1 then least(fr_mean, 1) else fr_mean end as false_rate_mean,
          fr_width as false_rate_width from st""",
    "delay_by_hop": _BASE + f""", dl as (select k, hop, delay_ms / 5000 as delay from det)
        select k, hop, {_stats("delay")} from dl group by k, hop""",
    "detection_online": _BASE + """
    select nk.node, nk.k, count(d.name) as detections,
      (select count(*) from truth where type = 'single' and online) as events,
      any_value(fp.false_positives) as false_positives
    from nk left join (select * from det where online) d on d.node = nk.node and d.k = nk.k
    join fp on fp.node = nk.node and fp.k = nk.k
    group by nk.node, nk.k""",
}
