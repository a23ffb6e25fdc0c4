"""Place clustering: J8, K1, K2."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import GEO_SQL, SQL, points, rnd
from dayprints.catalog.ordering import _TOP5
from dayprints.operators import dbscan as db
from dayprints.functions.time import epoch_seconds
from dayprints.operators import denstream as den
from dayprints.operators import filters
from dayprints.operators import microclusters as mc
from dayprints.operators import silhouette as silhouettes
from dayprints.session import cut_lineage

EPS = 0.00047


def _positions(spark, sf):
    rows = filters.no_sentinel(filters.geo(points(spark, sf))).select(
        "user", "event_id", "longitude", "latitude")
    return db.plain_points(rows)


def eps_neighbours(spark, sf):
    return db.core_points(_positions(spark, sf), db.Euclidean(EPS))


def dbscan(spark, sf):
    return db.dbscan(_positions(spark, sf), db.Euclidean(EPS))


def silhouette_squared(spark, sf):
    """How well the density clusters of a user's positions separate; noise is one more."""
    rows = _positions(spark, sf)
    labels = db.dbscan(rows, db.Euclidean(EPS)).select("event_id", "label")
    out = silhouettes.silhouette_squared(rows.join(labels, on="event_id"), "user")
    return out.withColumn("silhouette", rnd("silhouette", 5))


def _place_points(spark, sf):
    """Slow positions of a service with the wifi seen within a minute of them."""
    rows = points(spark, sf)
    positions = filters.place(rows).select(
        "service", "event_id", "ts", "longitude", "latitude", "altitude")
    return db.place_points(positions, rows.where("wifis is not null"), "service")


def dbscan_multimodal(spark, sf):
    return db.dbscan(cut_lineage(_place_points(spark, sf)), db.Multimodal(), by="service")


def denstream_init(spark, sf):
    """First clusters of a service's positions: 900 samples or more, one per label."""
    rows = filters.no_sentinel(filters.geo(points(spark, sf))).select(
        "service", "event_id", "ts", "longitude", "latitude")
    labels = db.dbscan(db.plain_points(rows), db.Euclidean(EPS), by="service")
    labelled = rows.join(labels.select("event_id", "label"), on="event_id")
    return den.initial_clusters(labelled, "service").select(
        "service", "creationTimeStamp", "N", "updated",
        *[rnd(c).alias(c) for c in ("weight", "LS1", "LS2", "SS1", "SS2")])


def _places(spark, sf):
    """Sums of the density clusters of all of a user's positions, typed by their weight."""
    rows = _track(spark, sf).select("user", "event_id", "ts", "longitude", "latitude",
                                    epoch_seconds("ts").alias("t"))
    labels = db.dbscan(db.plain_points(rows), db.Euclidean(EPS))
    sums = mc.cluster_summary(rows.join(labels.select("event_id", "label"), on="event_id"))
    heavy = F.col("weight") >= mc.Params().core_weight
    return cut_lineage(sums.withColumn(
        "type_cluster", F.when(heavy, mc.POTENTIAL).otherwise(mc.OUTLIER)))


SUMS = ["weight", "LS1", "LS2", "SS1", "SS2", "longitude", "latitude"]


def cluster_summary(spark, sf):
    return _places(spark, sf).select(
        "user", "label", "N", "creationTimeStamp", rnd("radius").alias("radius"),
        *[rnd(c).alias(c) for c in SUMS])


def denstream_prune(spark, sf):
    at = F.lit(PRUNED_AT).cast("bigint")
    return mc.prune(_places(spark, sf), at).select("user", "label", "type_cluster", "N")


def auto_params(spark, sf):
    return mc.auto_params(_places(spark, sf)).select(
        "user", rnd("epsilon").alias("epsilon"), rnd("mu", 3).alias("mu"))


def cluster_upsert(spark, sf):
    """What a check keeps replaces the stored places of the same user and type."""
    stored = _places(spark, sf)
    updated = mc.prune(stored, F.lit(PRUNED_AT).cast("bigint"))
    return mc.cluster_upsert(stored, updated).select("user", "type_cluster", "label", "N")


def load_user_clusters(spark, sf):
    samples = points(spark, sf).select(
        "user", F.col("event_id").alias("seq"), F.col("longitude").alias("x"),
        F.col("latitude").alias("y"))
    out = den.load_user_clusters(samples, _places(spark, sf), "user")
    return out.select("user", "seq", rnd("x").alias("x"), rnd("y").alias("y"),
                      F.coalesce("N", F.lit(0)).alias("n"))


def _track(spark, sf):
    return filters.no_sentinel(filters.geo(points(spark, sf)))


def plain(c, digits=6):
    """Rounded, and 0 for what rounds to -0."""
    return F.when(rnd(c, digits) == 0, 0.0).otherwise(rnd(c, digits))


def _rounded(df, columns):
    return df.withColumns({c: plain(c) for c in columns})


def denstream(spark, sf):
    """Clusters of each user after all samples, from none."""
    return _rounded(den.denstream(_track(spark, sf)), SUMS[:5])


def clusters_out(spark, sf):
    """Two runs: the first days, then the rest merged; other users keep what was saved."""
    rows = _track(spark, sf)
    saved = cut_lineage(den.denstream(rows.where("day <= date'2024-01-12'")))
    later = rows.where("day > date'2024-01-12'")
    merged = den.denstream(later, saved)
    out = den.clusters_out(merged.unionByName(den.untouched(saved, later, "user")))
    return _rounded(out, SUMS).withColumn("radius", plain("radius", 5))


PRUNED_AT = 1706000000  # 2024-01-23

QUERIES = {
    "eps_neighbours": eps_neighbours,
    "dbscan": dbscan,
    "silhouette_squared": silhouette_squared,
    "dbscan_multimodal": dbscan_multimodal,
    "cluster_summary": cluster_summary,
    "denstream": denstream,
    "denstream_prune": denstream_prune,
    "denstream_init": denstream_init,
    "clusters_out": clusters_out,
    "auto_params": auto_params,
    "cluster_upsert": cluster_upsert,
    "load_user_clusters": load_user_clusters,
}

_PAIRS = SQL + f""", p as (
      select event_id, "user", longitude as x, latitude as y from dp
      where {GEO_SQL} and longitude <> -1 and latitude <> -1),
    pr as (
      select a."user", a.event_id as a, b.event_id as b from p a join p b on a."user" = b."user"
      where sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {EPS}::double),
    core as (select a from pr group by a having count(*) >= 6)"""

# spread every neighbour minimum over pairs of core points, then take the smallest
_LABEL_CTES = """,
    cp as (select a, b from pr where a in (select a from core) and b in (select a from core)),
    mn as (select a, min(b) as l from cp group by a),
    reach(a, l) as (
      select a, l from mn union select c.b, r.l from reach r join cp c on r.a = c.a),
    cl as (select a, min(l) as label from reach group by a),
    lab as (
      select pr.a, min(cl.label) as label from pr join cl on pr.b = cl.a
      where pr.a not in (select a from core) group by pr.a
      union all select a, label from cl)"""
_LABELS = _LABEL_CTES + """
    select p.{by}, p.event_id, coalesce(lab.label, -1) as label
    from p left join lab on lab.a = p.event_id"""

_PLACES = _TOP5 + """, g as (
      select service, event_id, epoch_us(ts) // 1000 as t, longitude as x, latitude as y,
        case when altitude = 0 then 600 else altitude end as z
      from dp where longitude <> -1 and latitude <> -1 and accuracy < 90
        and speed < 0.5),
    c as (
      select g.event_id, s.event_id as scan_id, s.top, epoch_us(s.ts) // 1000 as st, g.t
      from g join sc s on s.service = g.service and abs(epoch_us(s.ts) // 1000 - g.t) <= 60000),
    n as (select *, row_number() over (partition by event_id order by abs(st - t), st > t,
      case when st > t then scan_id else -scan_id end) as rn from c),
    v as (select service, count(distinct h) as vocab
      from (select service, unnest(top) as h from sc) group by all),
    p as (
      select g.*, coalesce(n.top, []) as sig, v.vocab from g join v using (service)
      left join n on n.event_id = g.event_id and n.rn = 1),
    pr as (
      select a.event_id as a, b.event_id as b from p a join p b on a.service = b.service
      where sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) *
        (1 + 0.25::double / 10 * (abs(a.z - b.z) - 10) + 0.25::double / 0.001::double * (
          (len(a.sig) + len(b.sig) - 2 * len(list_intersect(a.sig, b.sig)))::double / a.vocab
          - 0.001::double)) <= 0.3::double / 6371),
    core as (select a from pr group by a having count(*) >= 6)"""

_SUMS = (_PAIRS.replace("with ", "with recursive ", 1).replace(
    'event_id, "user", longitude', 'event_id, "user", ts, longitude') + _LABEL_CTES + """,
    pl as (
      select p.*, lab.label, pow(2::double, -1e-5::double * (row_number() over (
        partition by "user", lab.label order by ts desc, event_id desc) - 1)) as w
      from p join lab on lab.a = p.event_id),
    a as (
      select "user", label, count(*) as n, cast(max(floor(epoch(ts))) as bigint) as created,
        sum(w) as weight, sum(x * w) as ls1, sum(y * w) as ls2,
        sum(x * x * w) as ss1, sum(y * y * w) as ss2
      from pl group by "user", label),
    r as (
      select *, greatest(sqrt(abs(ss1 / weight - pow(ls1 / weight, 2))),
        sqrt(abs(ss2 / weight - pow(ls2 / weight, 2)))) as radius,
        case when weight >= 6 then 'pMicroCluster' else 'oMicroCluster' end as type_cluster from a)""")

_STAYS = f"""weight >= case
          when type_cluster = 'pMicroCluster' then 6 else
          (pow(2::double, -1e-5::double * ({PRUNED_AT} - created + 1400)) - 1) /
          (pow(2::double, -1e-5::double * 1400) - 1) end"""

_RADIUS = ("sqrt(greatest(abs({c}.s1 / {c}.w - pow({c}.l1 / {c}.w, 2)), "
           "abs({c}.s2 / {c}.w - pow({c}.l2 / {c}.w, 2))))")
_PLACE = "struct(w double, l1 double, l2 double, s1 double, s2 double, n bigint, t0 bigint)"
_FADE = "pow(2::double, -1e-5::double)"


def _nearest(group: str) -> str:
    away = ("lambda c: sqrt(pow(x - c.l1 / c.w, 2) + pow(y - c.l2 / c.w, 2)) - "
            + _RADIUS.format(c="c"))
    return f"list_transform({group}, {away})"


def _grown(c: str) -> str:
    return (f"{{'w': {c}.w * f + 1, 'l1': {c}.l1 * f + x, 'l2': {c}.l2 * f + y, "
            f"'s1': {c}.s1 * f + x * x, 's2': {c}.s2 * f + y * y, 'n': {c}.n + 1, 't0': {c}.t0}}")


_FADED = ("{'w': c.w * f, 'l1': c.l1 * f, 'l2': c.l2 * f, 's1': c.s1 * f, 's2': c.s2 * f, "
          "'n': c.n, 't0': c.t0}")


def _after(group: str, kept: str, at: str, grown: str) -> str:
    """A group after a sample: faded, with the member that took it, if one did."""
    return (f"list_transform({group}, lambda c, j: case when {kept} and j = {at} then {grown} "
            f"else {_FADED} end)")


# every user's samples one by one, all users at once: clusters are lists in the user's row
_STATES = SQL.replace("with ", "with recursive ", 1) + f""", tr as (
      select "user", longitude as x, latitude as y, row_number() over (
        partition by "user" order by ts, event_id) as k
      from dp where {GEO_SQL} and longitude <> -1 and latitude <> -1),
    st("user", k, pot, outl) as (
      select distinct "user", 0::bigint, []::{_PLACE}[], []::{_PLACE}[] from tr
      union all
      select "user", k,
        case when k % 1400 = 0 then list_filter(pot2, lambda c: c.w >= 6) else pot2 end,
        case when k % 1400 = 0 then list_filter(outl2, lambda c: c.w >=
          (pow(2::double, -1e-5::double * (k - c.t0 + 1400)) - 1)
          / (pow(2::double, -1e-5::double * 1400) - 1)) else outl2 end
      from (
        select "user", k,
          case when fits_p then {_after("pot", "true", "pi", "pg")}
            when fits_o and og.w > 6 then list_append({_after("pot", "false", "0", "c")}, og)
            when not fits_o and near then list_append({_after("pot", "false", "0", "c")}, fresh)
            else {_after("pot", "false", "0", "c")} end as pot2,
          case when not fits_p and fits_o and og.w > 6
              then list_filter({_after("outl", "false", "0", "c")}, lambda c, j: j <> oi)
            when not fits_p and fits_o then {_after("outl", "true", "oi", "og")}
            when not fits_p and not near then list_append({_after("outl", "false", "0", "c")}, fresh)
            else {_after("outl", "false", "0", "c")} end as outl2
        from (
          select *, coalesce({_RADIUS.format(c="pg")} <= {EPS}::double, false) as fits_p,
            coalesce({_RADIUS.format(c="og")} <= {EPS}::double, false) as fits_o,
            len(list_filter(pot, lambda c: sqrt(pow(x - c.l1 / c.w, 2) + pow(y - c.l2 / c.w, 2))
              < 2 * {EPS}::double)) > 0 as near,
            {{'w': 1::double, 'l1': x, 'l2': y, 's1': x * x, 's2': y * y, 'n': 1::bigint,
              't0': k}} as fresh
          from (
            select *, case when pi is not null then {_grown("pot[pi]")} end as pg,
              case when oi is not null then {_grown("outl[oi]")} end as og
            from (
              select *, list_position(pd, list_min(pd)) as pi, list_position(od, list_min(od)) as oi
              from (
                select st."user", tr.k, tr.x, tr.y, st.pot, st.outl, {_FADE} as f,
                  {_nearest("st.pot")} as pd, {_nearest("st.outl")} as od
                from st join tr on tr."user" is not distinct from st."user"
                  and tr.k = st.k + 1)))))),
    ends as (select "user", max(k) as k from tr group by "user"),
    fin as (select st.* from st join ends on ends."user" is not distinct from st."user"
      and ends.k = st.k),
    cl as (
      select "user", k, c.*, 'pMicroCluster' as type_cluster
      from (select "user", k, unnest(pot) as c from fin)
      union all select "user", k, c.*, 'oMicroCluster'
      from (select "user", k, unnest(outl) as c from fin))"""



def _plain(value: str, digits: int = 6) -> str:
    return f"case when round({value}, {digits}) = 0 then 0 else round({value}, {digits}) end"


_SUM_COLUMNS = ", ".join(f'{_plain(c)} as "{name}"' for c, name in zip(
    ("w", "l1", "l2", "s1", "s2"), ("weight", "LS1", "LS2", "SS1", "SS2"), strict=True))
_STATE_SQL = f""" select "user", {_SUM_COLUMNS}, n as "N", t0 as "creationTimeStamp",
          type_cluster, k as updated"""

ORACLES = {
    "denstream": _STATES + _STATE_SQL + ", 0::bigint as last_step from cl",
    "clusters_out": _STATES + f"""
        select "user", t0 as "creationTimeStamp", {_plain("l1 / w")} as longitude,
          {_plain("l2 / w")} as latitude, {_plain(_RADIUS.format(c="cl"), 5)} as radius,
          {_SUM_COLUMNS}, n as "N", 2 as dimensions,
          0::double as altitude, '' as wifi, '' as bluetooth, '' as activities, '' as places,
          type_cluster from cl""",
    "eps_neighbours": _PAIRS + """
        select "user", event_id, cast(case when event_id in (select a from core) then 1 else 0 end
          as integer) as core from p""",
    "dbscan": (_PAIRS + _LABELS.format(by='"user"')).replace("with ", "with recursive ", 1),
    "silhouette_squared": (_PAIRS + _LABEL_CTES + """,
        pt as (
          select p."user", p.event_id, p.x, p.y, coalesce(lab.label, -1) as label
          from p left join lab on lab.a = p.event_id),
        sh as (
          select "user", label, count(*) as n, avg(x) as mx, avg(y) as my,
            var_pop(x) + var_pop(y) as v from pt group by all),
        d as (
          select pt."user", pt.event_id, sh.label = pt.label as own, sh.n,
            (x - mx) * (x - mx) + (y - my) * (y - my) + v as d
          from pt join sh on sh."user" = pt."user"),
        ab as (
          select "user", event_id, max(n) filter (where own) as size,
            max(case when own and n > 1 then d * n / (n - 1) end) as a,
            min(d) filter (where not own) as b from d group by all)
        select "user", round(avg(case when size = 1 then 0
          else coalesce((b - a) / nullif(greatest(a, b), 0), 0) end), 5) as silhouette
        from ab where b is not null group by "user\"""").replace(
            "with ", "with recursive ", 1),
    "dbscan_multimodal": (_PLACES + _LABELS.format(by="service")).replace(
        "with ", "with recursive ", 1),
    "denstream_init": (_PAIRS.replace('"user"', "service").replace(
        "event_id, service, longitude", "event_id, service, ts, longitude") + _LABEL_CTES + """,
        st as (
          select p.*, lab.label,
            row_number() over (partition by service order by ts, event_id) as t,
            count(*) over (partition by service) as samples
          from p left join lab on lab.a = p.event_id),
        e as (select service, max(t) as updated from st group by all),
        bk as (
          select *, pow(2::double, -1e-5::double * (row_number() over (
            partition by service, label order by ts desc, event_id desc) - 1)) as w
          from st where label is not null and samples >= 900)
        select service, max(t) as "creationTimeStamp", count(*) as "N", any_value(updated) as updated,
          round(sum(w), 6) as weight, round(sum(x * w), 6) as "LS1", round(sum(y * w), 6) as "LS2",
          round(sum(x * x * w), 6) as "SS1", round(sum(y * y * w), 6) as "SS2"
        from bk join e using (service) group by service, label""").replace(
            "with ", "with recursive ", 1),
    "cluster_summary": _SUMS + """
        select "user", label, n as "N", created as "creationTimeStamp",
          round(radius, 6) as radius, round(weight, 6) as weight, round(ls1, 6) as "LS1",
          round(ls2, 6) as "LS2", round(ss1, 6) as "SS1", round(ss2, 6) as "SS2",
          round(ls1 / weight, 6) as longitude, round(ls2 / weight, 6) as latitude from r""",
    "denstream_prune": _SUMS + f"""
        select "user", label, type_cluster, n as "N" from r where {_STAYS}""",
    "auto_params": _SUMS + """
        select "user", round(arg_min(radius, label) * 1.2, 6) as epsilon,
          round(1 / (1 - pow(2::double, -1e-5::double)), 3) as mu from r group by "user\"""",
    "cluster_upsert": _SUMS + f""", k as (select *, {_STAYS} as stays from r)
        select "user", type_cluster, label, n as "N" from k
        qualify stays or not bool_or(stays) over (partition by "user", type_cluster)""",
    "load_user_clusters": _SUMS + """,
        sm as (select "user", event_id, longitude, latitude from dp)
        select "user", event_id as seq, round(longitude, 6) as x, round(latitude, 6) as y,
          0::bigint as n from sm
        union all select "user", 0, round(ls1 / weight, 6), round(ls2 / weight, 6), n from r
          where "user" in (select "user" from sm)""",
}
