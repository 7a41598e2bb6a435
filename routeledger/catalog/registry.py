"""Registry, municipal-view and ordered-operator queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.catalog import Registry
from routeledger.lens_sql import with_lenses
from routeledger.lenses import Lens
from routeledger.operators import layout, ordered, registry
from routeledger.plans import operator_rows, registry_text, vehicle_rows
from routeledger.session import shared_folder

R = Registry()
_WELFARE, _GAP = V.TRANSPORT_TYPES
_TYPES = ("寝台車", "車いす車", "兼用車", "回転シート車", "セダン等", "普通自動車", "バス")

CTES = {
    "roster": """SELECT n_nationkey AS roster_ord, n_name AS municipality FROM nation""",
    "ops": f"""
        SELECT s_suppkey, 'P' || (s_suppkey % 4) AS source_pdf,
               'R' || (s_suppkey // 4) AS registration_no,
               CASE WHEN s_suppkey % 2 = 0 THEN '{_WELFARE}' ELSE '{_GAP}' END AS transport_type,
               s_nationkey % 20 AS a, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey % 20 + 1 END AS b,
               DATE '1995-01-01' + CAST((s_suppkey * 17) % 1500 AS INTEGER) AS valid_from
        FROM supplier""",
    "op_area": """
        SELECT ops.*, 'NATION_' || a AS municipality FROM ops
        UNION ALL SELECT ops.*, 'NATION_' || b FROM ops WHERE b IS NOT NULL""",
    "veh": f"""
        SELECT l_suppkey, l_linenumber AS office_seq,
               ['{"', '".join(_TYPES)}'][CAST(l_partkey % 7 + 1 AS INTEGER)] AS vehicle_type,
               CAST(l_quantity AS BIGINT) AS n,
               CASE WHEN l_linenumber <> 6 THEN least(CAST(l_quantity AS BIGINT), l_partkey % 5)
               END AS kei
        FROM lineitem""",
    "op_sum": """
        SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS vehicles_total,
               CAST(sum(coalesce(kei, 0)) AS BIGINT) AS vehicles_total_kei
        FROM veh GROUP BY l_suppkey""",
    "op_full": """
        SELECT op_area.*, coalesce(vehicles_total, 0) AS vehicles_total,
               coalesce(vehicles_total_kei, 0) AS vehicles_total_kei
        FROM op_area LEFT JOIN op_sum ON l_suppkey = s_suppkey""",
}


def sql(query: str, extra: dict[str, str] | None = None) -> str:
    return with_lenses(query, {**CTES, **(extra or {})})


def roster(lens: Lens):
    n = lens.table("nation")
    return n.select(F.col("n_nationkey").alias("roster_ord"), F.col("n_name").alias("municipality"))


def _key(k):
    return [F.concat(F.lit("P"), (k % 4).cast("string")).alias("source_pdf"),
            F.concat(F.lit("R"), F.call_function("div", k, F.lit(4)).cast("string"))
            .alias("registration_no")]


def vehicles(lens: Lens):
    """Detail rows straight from line items."""
    k, q = F.col("l_partkey"), F.col("l_quantity").cast("bigint")
    kind = F.element_at(F.array(*map(F.lit, _TYPES)), (k % 7 + 1).cast("int"))
    return lens.table("lineitem").select(
        *_key(F.col("l_suppkey")), F.col("l_suppkey"), F.col("l_linenumber").alias("office_seq"),
        kind.alias("vehicle_type"), q.alias("count"),
        F.when(F.col("l_linenumber") != 6, F.least(q, k % 5)).alias("count_kei"))


def vehicles_with_totals(lens: Lens):
    """Detail rows plus one printed total per office, wrong where the supplier divides by 11."""
    v = vehicles(lens)
    off = F.when(F.col("l_suppkey") % 11 == 0, 1).otherwise(0)
    totals = v.groupBy("source_pdf", "registration_no", "l_suppkey", "office_seq").agg(
        F.sum("count").alias("c"), F.sum(F.coalesce("count_kei", F.lit(0))).alias("count_kei")
    ).select("source_pdf", "registration_no", "l_suppkey", "office_seq",
             F.lit(V.TOTAL_LABEL).alias("vehicle_type"), (F.col("c") + off).alias("count"),
             "count_kei")
    return v.unionByName(totals)


def operators(lens: Lens, totals: bool = True):
    k = F.col("s_suppkey")
    base = F.col("s_nationkey") % 20
    name = lambda c: F.concat(F.lit("NATION_"), c.cast("string"))
    area = F.concat_ws(";", name(base), F.when(k % 3 == 0, name(base + 1)))
    start = F.date_add(F.lit(date(1995, 1, 1)), ((k * 17) % 1500).cast("int"))
    ops = lens.table("supplier").select(
        *_key(k), k.alias("s_suppkey"),
        F.when(k % 2 == 0, _WELFARE).otherwise(_GAP).alias("transport_type"),
        area.alias("service_area_municipalities"), start.alias("valid_from"))
    if not totals:
        return ops
    sums = vehicles(lens).groupBy("l_suppkey").agg(
        F.sum("count").alias("vehicles_total"),
        F.sum(F.coalesce("count_kei", F.lit(0))).alias("vehicles_total_kei"))
    return ops.join(sums, k == F.col("l_suppkey"), "left").drop("l_suppkey").na.fill(
        0, ["vehicles_total", "vehicles_total_kei"])


# -- totals -----------------------------------------------------------------------------------


@R.add("nonzero_rows", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, count, count_kei FROM (
        SELECT *, CAST(l_quantity AS BIGINT) % 3 AS count,
               CASE WHEN l_linenumber <> 6 THEN l_partkey % 2 END AS count_kei FROM lineitem)
    WHERE NOT (count = 0 AND coalesce(count_kei, 0) = 0)""")
def nonzero_rows(spark, sf_dir):
    li = Lens(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        (F.col("l_quantity").cast("bigint") % 3).alias("count"),
        F.when(F.col("l_linenumber") != 6, F.col("l_partkey") % 2).alias("count_kei"))
    return registry.nonzero_rows(li)


@R.add("reconcile_totals", sql("""
    SELECT source_pdf, registration_no, printed AS vehicles_total, vehicles_total_kei,
           detail_count, detail_kei, office_mismatches,
           printed = detail_count AND office_mismatches = 0 AS is_consistent
    FROM (SELECT source_pdf, registration_no,
                 coalesce(vehicles_total, 0) + CASE WHEN s_suppkey % 13 = 0 THEN 1 ELSE 0 END
                     AS printed,
                 coalesce(vehicles_total_kei, 0) AS vehicles_total_kei,
                 coalesce(vehicles_total, 0) AS detail_count,
                 coalesce(vehicles_total_kei, 0) AS detail_kei,
                 CASE WHEN s_suppkey % 11 = 0 THEN coalesce(offices, 0) ELSE 0 END
                     AS office_mismatches
          FROM ops LEFT JOIN op_sum ON l_suppkey = s_suppkey
          LEFT JOIN (SELECT l_suppkey AS k, count(DISTINCT l_linenumber) AS offices
                     FROM lineitem GROUP BY 1) ON k = s_suppkey)"""))
def reconcile_totals(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    off = F.when(F.col("s_suppkey") % 13 == 0, 1).otherwise(0)
    ops = operators(lens).withColumn("vehicles_total", F.col("vehicles_total") + off)
    return registry.reconcile_totals(ops, vehicles_with_totals(lens))


@R.add("inner_le_outer", """
    SELECT 'P' || (l_suppkey % 4) AS source_pdf,
           count(*) FILTER (WHERE l_linenumber <> 6) AS checked,
           count(*) FILTER (WHERE l_linenumber <> 6 AND l_partkey % 5 > l_quantity) AS violations
    FROM lineitem GROUP BY l_suppkey % 4""")
def inner_le_outer(spark, sf_dir):
    li = Lens(spark, sf_dir).table("lineitem").select(
        *_key(F.col("l_suppkey")), F.col("l_quantity").cast("bigint").alias("count"),
        F.when(F.col("l_linenumber") != 6, F.col("l_partkey") % 5).alias("count_kei"))
    return registry.inner_le_outer(li)


@R.add("office_flags", """
    SELECT 'P' || (k % 4) AS source_pdf, 'R' || (k // 4) AS registration_no, n_top,
           n_top - CASE WHEN k % 5 = 2 THEN has7 ELSE 0 END AS n_vehicle,
           CASE WHEN k % 5 = 2 AND has7 = 1 THEN 'office_mismatch'
                WHEN k % 5 = 0 AND has3 = 1 THEN 'office_mismatch'
                WHEN k % 5 = 1 AND has3 = 1 THEN 'office_notation_diff'
                WHEN k % 5 = 4 AND has3 + has5 = 2 THEN 'office_notation_diff;office_mismatch'
                WHEN k % 5 = 4 AND has3 = 1 THEN 'office_notation_diff'
                WHEN k % 5 = 4 AND has5 = 1 THEN 'office_mismatch' ELSE '' END AS flags
    FROM (SELECT l_suppkey AS k, count(DISTINCT l_linenumber) AS n_top,
                 max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS has3,
                 max(CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END) AS has5,
                 max(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS has7
          FROM lineitem GROUP BY l_suppkey)""")
def office_flags(spark, sf_dir):
    li = Lens(spark, sf_dir).table("lineitem")
    k, seq = F.col("l_suppkey"), F.col("l_linenumber")
    top = li.select("l_suppkey", "l_linenumber").distinct().select(
        k, *_key(k), seq.alias("office_seq"),
        F.concat(F.lit("支所 "), seq.cast("string")).alias("office_name"),
        F.concat(F.lit("町"), seq.cast("string"), F.lit("-1")).alias("office_location"))
    form, s = k % 5, F.col("office_seq")
    name = (F.when((form == 0) & (s == 3), "他所").when((form == 4) & (s == 5), "他所")
            .when(form == 3, F.concat(F.lit("支所　"), F.translate(s.cast("string"), "1234567",
                                                                   "１２３４５６７")))
            .when((form == 1) & (s == 2), "").otherwise(F.col("office_name")))
    loc = F.when(form.isin(1, 4) & (s == 3), "町3番地").otherwise(F.col("office_location"))
    veh = top.where(~((form == 2) & (s == 7))).select(
        "source_pdf", "registration_no", "office_seq", name.alias("office_name"),
        loc.alias("office_location"))
    return registry.office_flags(top, veh)


@R.add("period_sanity", sql("""
    SELECT source_pdf, registration_no, valid_from, valid_to,
           CASE WHEN valid_from >= valid_to THEN 'not_ascending'
                WHEN year(valid_from) < 1996 THEN 'year_out_of_range'
                WHEN s_suppkey % 5 = 3 THEN 'unusual_length' END AS warning
    FROM periods""", {"periods": """
        SELECT *, CAST(CASE s_suppkey % 5
            WHEN 0 THEN valid_from + INTERVAL 24 MONTH - INTERVAL 1 DAY
            WHEN 1 THEN valid_from + INTERVAL 36 MONTH - INTERVAL 1 DAY
            WHEN 2 THEN valid_from + INTERVAL 60 MONTH - INTERVAL 1 DAY
            WHEN 3 THEN valid_from + INTERVAL 36 MONTH + INTERVAL 7 DAY
            ELSE valid_from - INTERVAL 1 DAY END AS DATE) AS valid_to FROM ops"""}))
def period_sanity(spark, sf_dir):
    k, s = F.col("s_suppkey") % 5, F.col("valid_from")
    end = (F.when(k == 0, F.date_sub(F.add_months(s, 24), 1))
           .when(k == 1, F.date_sub(F.add_months(s, 36), 1))
           .when(k == 2, F.date_sub(F.add_months(s, 60), 1))
           .when(k == 3, F.date_add(F.add_months(s, 36), 7)).otherwise(F.date_sub(s, 1)))
    ops = operators(Lens(spark, sf_dir), totals=False).withColumn("valid_to", end)
    return registry.period_sanity(ops, low=1996)


@R.add("expiring_soon", """
    SELECT 'C' || (o_custkey % 4) AS source_pdf, CAST(o_orderkey AS VARCHAR) AS registration_no,
           CAST(o_orderdate AS DATE) AS valid_to
    FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-15' AND DATE '1997-09-15'""")
def expiring_soon(spark, sf_dir):
    o = Lens(spark, sf_dir).table("orders").select(
        F.concat(F.lit("C"), (F.col("o_custkey") % 4).cast("string")).alias("source_pdf"),
        F.col("o_orderkey").cast("string").alias("registration_no"),
        F.to_date("o_orderdate").alias("valid_to"))
    return registry.expiring_soon(o, date(1997, 3, 15))


@R.add("registry_contract", """
    SELECT rule_id, 'P' || (k % 4) AS source_pdf, 'R' || (k // 4) AS registration_no,
           CAST(CASE WHEN k % 19 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n
    FROM (SELECT s_suppkey AS k, unnest(['service_type_code', 'authority_code',
                 'scope_in_gap_area', 'partner_not_empty', 'duplicate_key']) AS rule_id
          FROM supplier)
    WHERE CASE rule_id WHEN 'service_type_code' THEN k % 7 = 0
               WHEN 'authority_code' THEN k % 9 = 0
               WHEN 'scope_in_gap_area' THEN k % 2 = 1 AND k % 5 = 0
               WHEN 'partner_not_empty' THEN k % 17 = 0 ELSE k % 19 = 0 END""")
def registry_contract(spark, sf_dir):
    k = F.col("s_suppkey")
    code = F.when(k % 7 == 0, "無").when(k % 2 == 0, "福").when(k % 4 == 1, "交").otherwise("過")
    ops = operators(Lens(spark, sf_dir), totals=False).withColumns({
        "service_type_code": code,
        "authority_code": F.when(k % 9 == 0, "神戸市").otherwise("中山"),
        "partner_operator_name": F.when(k % 17 == 0, "協力者").otherwise(""),
        "partner_operator_address": F.lit(""),
        **{c: F.when((k % 2 == 0) | (k % 5 == 0), 1).otherwise(0)
           for c in V.SCOPE_COLUMNS.values()},
    })
    return registry.registry_contract(ops.unionByName(ops.where(k % 19 == 0)), "中山")


# -- municipal views --------------------------------------------------------------------------


@R.add("municipal_supply", sql("""
    SELECT roster_ord, municipality, count(s_suppkey) AS operator_count,
           CAST(coalesce(sum(vehicles_total), 0) AS BIGINT) AS vehicles_total,
           CAST(coalesce(sum(vehicles_total_kei), 0) AS BIGINT) AS vehicles_total_kei
    FROM roster LEFT JOIN op_full USING (municipality) GROUP BY roster_ord, municipality"""))
def municipal_supply(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return registry.municipal_supply(operators(lens), roster(lens))


@R.add("municipal_supply_by_type", sql(f"""
    SELECT roster_ord, municipality, t.transport_type, count(s_suppkey) AS operator_count,
           CAST(coalesce(sum(vehicles_total), 0) AS BIGINT) AS vehicles_total,
           CAST(coalesce(sum(vehicles_total_kei), 0) AS BIGINT) AS vehicles_total_kei
    FROM roster CROSS JOIN (SELECT unnest(['{_WELFARE}', '{_GAP}']) AS transport_type) t
    LEFT JOIN op_full USING (municipality, transport_type)
    GROUP BY roster_ord, municipality, t.transport_type"""))
def municipal_supply_by_type(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return registry.municipal_supply_by_type(operators(lens), roster(lens))


@R.add("unique_vs_exploded", sql("""
    SELECT * FROM (
        SELECT count(*) AS unique_operators,
               CAST(sum(coalesce(vehicles_total, 0)) AS BIGINT) AS unique_vehicles,
               CAST(sum(coalesce(vehicles_total_kei, 0)) AS BIGINT) AS unique_kei
        FROM ops LEFT JOIN op_sum ON l_suppkey = s_suppkey)
    CROSS JOIN (
        SELECT count(*) AS summed_operators,
               CAST(sum(vehicles_total) AS BIGINT) AS summed_vehicles,
               CAST(sum(vehicles_total_kei) AS BIGINT) AS summed_kei FROM op_full)"""))
def unique_vs_exploded(spark, sf_dir):
    return registry.unique_vs_exploded(operators(Lens(spark, sf_dir)))


@R.add("vehicle_mix", sql("""
    SELECT municipality, vehicle_type, CAST(sum(n) AS BIGINT) AS vehicle_count
    FROM op_area JOIN veh ON l_suppkey = s_suppkey GROUP BY municipality, vehicle_type"""))
def vehicle_mix(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return registry.vehicle_mix(operators(lens, totals=False), vehicles_with_totals(lens))


# -- ordered operators ------------------------------------------------------------------------


@R.add("page_blocks", """
    SELECT conv_id, turn, CASE WHEN k = 'anchor' THEN start_turn END AS block_start,
           CASE WHEN role = 'system' THEN 'dropped' WHEN k = 'anchor' THEN 'block'
                ELSE 'error_continuation_without_start' END AS state
    FROM (SELECT conv_id, turn, role, m.turn AS start_turn, m.kind AS k FROM (
        SELECT *, max(CASE WHEN role = 'user' THEN {'turn': turn, 'kind': 'anchor'}
                           WHEN role = 'system' THEN {'turn': turn, 'kind': 'appendix'} END)
                  OVER (PARTITION BY conv_id ORDER BY turn) AS m FROM conversations))""")
def page_blocks(spark, sf_dir):
    pages = Lens(spark, sf_dir).table("conversations").select("conv_id", "turn", "role")
    return ordered.page_blocks(
        pages, "conv_id", "turn", F.col("role") == "user", F.col("role") == "system"
    ).select("conv_id", "turn", "block_start", "state")


@R.add("seq_numbering", """
    SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq
    FROM events WHERE event_type <> 'error'""")
def seq_numbering(spark, sf_dir):
    e = Lens(spark, sf_dir).table("events").where(F.col("event_type") != "error")
    return ordered.numbered(e.select("user_id", "event_id"), ["user_id"], "event_id", "seq")


# -- layout -----------------------------------------------------------------------------------

_WORDS = {"words": """
    SELECT l_orderkey AS page, l_orderkey * 8 + l_linenumber AS idx0,
           CAST(l_partkey % 500 AS DOUBLE) AS x0, CAST(l_partkey % 500 + 8 AS DOUBLE) AS x1,
           CAST(l_linenumber * 12 AS DOUBLE) AS top, CAST(l_linenumber * 12 + 10 AS DOUBLE) AS bottom,
           l_returnflag AS text, l_suppkey * 1000000 + CAST(l_extendedprice AS BIGINT) AS word_idx
    FROM lineitem"""}


def _words(lens: Lens, lineitem=None):
    x0, top = (F.col("l_partkey") % 500).cast("double"), (F.col("l_linenumber") * 12).cast("double")
    idx = F.col("l_suppkey") * 1000000 + F.rint("l_extendedprice").cast("bigint")
    return (lens.table("lineitem") if lineitem is None else lineitem).select(
        F.col("l_orderkey").alias("page"), F.col("l_returnflag").alias("text"),
        x0.alias("x0"), (x0 + 8).alias("x1"), top.alias("top"), (top + 10).alias("bottom"),
        idx.alias("word_idx"))


@R.add("words_in_box", with_lenses("""
    SELECT box_id, page, text, x0, x1, top, bottom, word_idx FROM words,
           (SELECT unnest(['left', 'right']) AS box_id)
    WHERE CASE box_id WHEN 'left' THEN (x0 + x1) / 2 BETWEEN 104 AND 254
                                        AND (top + bottom) / 2 BETWEEN 17 AND 53
                      ELSE (x0 + x1) / 2 >= 400 AND (top + bottom) / 2 <= 41 END""", _WORDS))
def words_in_box(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    d = lambda v: F.lit(v).cast("double")
    box = F.explode(F.array(
        F.struct(F.lit("left").alias("box_id"), d(104).alias("x0"), d(254).alias("x1"),
                 d(17).alias("top"), d(53).alias("bottom")),
        F.struct(F.lit("right").alias("box_id"), d(400).alias("x0"), d(None).alias("x1"),
                 d(None).alias("top"), d(41).alias("bottom"))))
    boxes = lens.table("lineitem").select(F.col("l_orderkey").alias("page")).distinct().select(
        "page", box.alias("b")).select("page", "b.*")
    return layout.words_in_box(_words(lens), boxes)


@R.add("find_label", with_lenses("""
    SELECT page, w.word_idx AS word_idx, w.x0 AS x0, w.x1 AS x1, w.top AS top, w.bottom AS bottom
    FROM (SELECT page, first(struct_pack(word_idx, x0, x1, top, bottom) ORDER BY top, word_idx, x0)
                 AS w
          FROM words WHERE text = 'A' AND x0 < 300 AND top < 60 GROUP BY page)""", _WORDS))
def find_label(spark, sf_dir):
    return layout.find_label(_words(Lens(spark, sf_dir)), "A", 300, 60)


@R.add("gap_join", with_lenses("""
    SELECT page, top, string_agg(piece, '' ORDER BY rn) AS text FROM (
        SELECT page, top, rn, CASE WHEN x0 - prev > 7 THEN ' ' || text ELSE text END AS piece
        FROM (SELECT *, lag(x1) OVER w AS prev, row_number() OVER w AS rn FROM words
              WINDOW w AS (PARTITION BY page, top ORDER BY x0, word_idx)))
    GROUP BY page, top""", _WORDS))
def gap_join(spark, sf_dir):
    return layout.gap_join(_words(Lens(spark, sf_dir)), ["page", "top"], 7.0)


@R.add("label_value", with_lenses("""
    SELECT page, string_agg(piece, '' ORDER BY rn) AS text FROM (
        SELECT page, rn, CASE WHEN x0 - prev > 7 THEN ' ' || text ELSE text END AS piece
        FROM (SELECT *, lag(x1) OVER v AS prev, row_number() OVER v AS rn FROM (
                SELECT w.* FROM words w JOIN (
                    SELECT page, min(top) AS t FROM words WHERE text = 'A' GROUP BY page) l
                ON l.page = w.page AND (w.top + w.bottom) / 2 BETWEEN l.t - 3 AND l.t + 13
                   AND (w.x0 + w.x1) / 2 >= 150)
              WINDOW v AS (PARTITION BY page ORDER BY x0, word_idx)))
    GROUP BY page""", _WORDS))
def label_value(spark, sf_dir):
    return layout.label_value(_words(Lens(spark, sf_dir)), "A", 150.0)


@R.add("leader_cluster", with_lenses("""
    SELECT page, array_to_string(list_transform(list_reduce(
               list_transform(list_sort(list(DISTINCT x0)), lambda x: [x]),
               lambda acc, x: CASE WHEN x[1] - acc[len(acc)] < 40 THEN acc
                                   ELSE list_concat(acc, x) END),
               lambda x: CAST(CAST(x AS INTEGER) AS VARCHAR)), ';') AS leaders
    FROM words GROUP BY page""", _WORDS))
def leader_cluster(spark, sf_dir):
    c = layout.leader_clusters(_words(Lens(spark, sf_dir)), ["page"], "x0", 40.0)
    return c.select("page", F.array_join(
        F.transform("leaders", lambda x: x.cast("int").cast("string")), ";").alias("leaders"))


@R.add("grid_cells", with_lenses("""
    SELECT page, row_no, col_no, string_agg(piece, '' ORDER BY rn) AS text FROM (
        SELECT page, row_no, col_no, rn,
               CASE WHEN x0 - prev > 7 THEN ' ' || text ELSE text END AS piece
        FROM (SELECT *, lag(x1) OVER v AS prev, row_number() OVER v AS rn FROM (
                SELECT *, CAST(dense_rank() OVER (PARTITION BY page ORDER BY top) AS INTEGER)
                       AS row_no FROM words)
              JOIN (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS col_no)
                ON x0 + 4 BETWEEN 70 * (col_no - 1) AND 70 * col_no
              WINDOW v AS (PARTITION BY page, row_no, col_no ORDER BY x0, word_idx)))
    GROUP BY page, row_no, col_no""", _WORDS))
def grid_cells(spark, sf_dir):
    """Words of an order inside a grid: column rules every 70 points, one drawn twice."""
    w = _words(Lens(spark, sf_dir))
    xs = F.array(*[F.lit(float(x)) for x in range(0, 491, 70)], F.lit(141.5))
    v = w.select("page").distinct().select("page", F.explode(xs).alias("x0")).select(
        "page", F.lit("v").alias("orientation"), "x0", F.lit(0.0).alias("top"))
    h = w.select("page", F.lit("h").alias("orientation"), F.lit(0.0).alias("x0"),
                 (F.col("top") - 1).alias("top"))
    last = w.groupBy("page").agg(F.max("bottom").alias("top")).select(
        "page", F.lit("h").alias("orientation"), F.lit(0.0).alias("x0"), "top")
    return layout.grid_cells(w, v.unionByName(h).unionByName(last))


_FOUND = {**_WORDS, "found": """
    SELECT page, ln + 1 AS row_no, col_no, 70.0 * (col_no - 1) AS x0, 70.0 * col_no AS x1,
           12.0 * ln - 1 + CASE WHEN col_no % 3 = 0 THEN 8 ELSE 0 END AS top, 12.0 * ln + 11 AS bottom
    FROM (SELECT DISTINCT l_orderkey AS page, CAST(l_linenumber AS INTEGER) AS ln FROM lineitem),
         (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS col_no)
    WHERE (page + 3 * ln + col_no) % 4 <> 0
    UNION ALL
    SELECT page, 1, col_no, 70.0 * (col_no - 1), 70.0 * col_no, 0.0, 10.0
    FROM (SELECT DISTINCT l_orderkey AS page FROM lineitem),
         (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS col_no)
    WHERE page % 5 <> 0 OR col_no <> 7"""}


@R.add("grid_recovered", with_lenses("""
    SELECT m.page, m.row_no, m.col_no, coalesce(string_agg(text, chr(10) ORDER BY w.top, w.x0, word_idx), '') AS text
    FROM (SELECT page, row_no, col_no, h.x0, h.x1, r.top, r.bottom
          FROM (SELECT page, row_no, min(top) AS top, max(bottom) AS bottom FROM found WHERE row_no > 1
                GROUP BY page, row_no) r
          JOIN (SELECT page, col_no, x0, x1 FROM found WHERE row_no = 1) h USING (page)
          ANTI JOIN found USING (page, row_no, col_no)) m
    LEFT JOIN words w ON w.page = m.page AND (w.x0 + w.x1) / 2 BETWEEN m.x0 AND m.x1
                      AND (w.top + w.bottom) / 2 BETWEEN m.top AND m.bottom
    GROUP BY m.page, m.row_no, m.col_no""", _FOUND))
def grid_recovered(spark, sf_dir):
    """A table of seven columns per order that lacks a quarter of its boxes, and one heading on every fifth page."""
    lens = Lens(spark, sf_dir)
    dealt = lens.spread("lineitem", "l_orderkey", 250_000)
    lines = dealt.select(
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("int").alias("ln")).distinct()
    col = F.explode(F.array(*map(F.lit, range(1, 8)))).alias("col_no")
    box = [(70.0 * (F.col("col_no") - 1)).alias("x0"), (70.0 * F.col("col_no")).alias("x1")]
    data = lines.select("page", "ln", col).where((F.col("page") + 3 * F.col("ln") + F.col("col_no")) % 4 != 0).select(
        "page", (F.col("ln") + 1).alias("row_no"), "col_no", *box,
        (12.0 * F.col("ln") - 1 + F.when(F.col("col_no") % 3 == 0, 8).otherwise(0)).alias("top"),
        (12.0 * F.col("ln") + 11).alias("bottom"))
    heads = lines.select("page").distinct().select("page", col).where(
        (F.col("page") % 5 != 0) | (F.col("col_no") != 7)).select(
        "page", F.lit(1).alias("row_no"), "col_no", *box, F.lit(0.0).alias("top"), F.lit(10.0).alias("bottom"))
    return layout.recovered_cells(_words(lens, dealt), data.unionByName(heads))


@R.add("cell_split", """
    SELECT c_custkey, 'Office' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' ' END || (c_custkey % 50) AS name,
           CASE WHEN c_custkey % 3 = 2 THEN 'annexTown 1-' || c_nationkey
                ELSE 'Town 1-' || c_nationkey END AS location
    FROM customer""")
def cell_split(spark, sf_dir):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    office = F.concat(F.lit("Office "), (k % 50).cast("string"))
    town = F.concat(F.lit("Town 1-"), n)
    cell = (F.when(k % 3 == 0, F.concat(F.lit("Office \n"), (k % 50).cast("string"), F.lit("\n"), town))
            .when(k % 3 == 1, F.concat(office, F.lit("\nTown 1-\n"), n))
            .otherwise(F.concat(office, F.lit("\nannex\n"), town)))
    ref = F.translate(office, "0123456789", "０１２３４５６７８９")
    s = layout.cell_split(cell, ref, town)
    return Lens(spark, sf_dir).table("customer").select("c_custkey", s.alias("s")).select(
        "c_custkey", "s.name", "s.location")


# -- page texts to operators ------------------------------------------------------------------

_PAGES = {"pg": """
    SELECT c_custkey AS k, 'D' || (c_custkey // 8) AS doc_id, CAST(c_custkey % 8 AS INTEGER) AS page_no,
           c_nationkey AS n, 'NATION_' || c_nationkey || '市' AS org,
           'NATION_' || (c_custkey % 25) || '市' AS place,
           CASE WHEN c_custkey % 8 = 7 AND c_custkey // 8 % 3 = 0 THEN 'appendix'
                WHEN c_custkey % 8 IN (2, 5)
                     OR (c_custkey % 8 = 0 AND c_custkey // 8 % 5 <> 4) THEN 'anchor' END AS kind
    FROM customer""",
    "st": """
    SELECT *, CASE WHEN m.kind = 'anchor' THEN m.page_no END AS block_start
    FROM (SELECT *, max(CASE WHEN kind IS NOT NULL THEN {'page_no': page_no, 'kind': kind} END)
                    OVER (PARTITION BY doc_id ORDER BY page_no) AS m FROM pg)"""}


def _registry_pages(lens: Lens):
    """Page texts of a registry: eight pages per document, three of them forms."""
    k = F.col("c_custkey")
    s = lambda c: c.cast("string")
    doc, page = F.call_function("div", k, F.lit(8)), k % 8
    org = F.concat(F.lit("NATION_"), s(F.col("c_nationkey")), F.lit("市"))
    place = F.concat(F.lit("NATION_"), s(k % 25), F.lit("市"))
    area = F.concat(F.lit("\n本郷線 起点 "), place, F.lit("一丁目～終点 県道\n路線又は\n運送の区域"))
    form = F.concat(
        F.lit("自家用有償旅客運送者登録簿\n登 録 番 号 中山市交第 "), s(k), F.lit(" 号\n"
              "登録年月日及び 登録年月日：H18.10.1\n更新登録年月日 更新登録年月日：R5.10."),
        s(1 + k % 28), F.lit("～R8.9.30\n名 称 "), org, F.lit("\n代表者の氏名 市長 某\n住 所 "),
        org, F.lit("１－"), s(k), F.lit("\n交 通 空 白 地 有 償 運 送\n運送の種別\n○"), area)
    appendix = (page == 7) & (doc % 3 == 0)
    anchor = page.isin(2, 5) | ((page == 0) & (doc % 5 != 4))
    return lens.spread("customer", "c_custkey", 10_000).select(
        F.concat(F.lit("D"), s(doc)).alias("doc_id"), page.cast("int").alias("page_no"),
        F.when(appendix, "輸送人員実績報告提出状況（R４年度～）").when(anchor, form)
        .otherwise(F.concat(F.lit("続き"), area)).alias("text"))


_MARKER = "輸送人員実績報告提出状況"


_OPERATORS = """
    SELECT a.doc_id AS source_pdf, a.page_no AS source_page, page_count,
           '中山市交第' || a.k || '号' AS registration_no,
           '中山市交第 ' || a.k || ' 号' AS registration_no_raw, '中山' AS authority_code,
           '交' AS service_type_code, CAST(a.k AS VARCHAR) AS serial_no, 'T' AS operator_type,
           '交通空白地有償運送' AS transport_type, a.org AS org_name,
           a.org || '1-' || a.k AS org_address, a.org || '１－' || a.k AS org_address_raw,
           CASE WHEN own THEN places ELSE a.org || ';' || places END
               AS service_area_municipalities,
           '2006-10-01' AS registered_date,
           printf('2023-10-%02d', CAST(1 + a.k % 28 AS INTEGER)) AS renewed_date,
           printf('2023-10-%02d', CAST(1 + a.k % 28 AS INTEGER)) AS valid_from,
           '2026-09-30' AS valid_to, CAST(NULL AS VARCHAR) AS problem
    FROM st a JOIN (
        SELECT doc_id, block_start, count(*) AS page_count,
               string_agg(place, ';' ORDER BY page_no) AS places
        FROM st WHERE block_start IS NOT NULL GROUP BY doc_id, block_start) b
      ON b.doc_id = a.doc_id AND b.block_start = a.page_no
    JOIN LATERAL (SELECT bool_or(c.place = a.org) AS own FROM st c
                  WHERE c.doc_id = a.doc_id AND c.block_start = a.page_no) ON true"""


@R.add("registry_from_text", with_lenses(_OPERATORS, _PAGES))
def registry_from_text(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    pages = _registry_pages(lens)
    states = registry_text.page_states(registry_text.page_fields(pages, _MARKER))
    places = lens.table("nation").select(F.concat("n_name", F.lit("市")).alias("municipality"))
    kinds = pages.select("doc_id").distinct().withColumn("operator_type", F.lit("T"))
    return registry_text.registry_from_text(states, places, kinds)


@R.add("registry_page_problems", with_lenses("""
    SELECT doc_id, page_no, 'error_continuation_without_start' AS problem
    FROM st WHERE block_start IS NULL AND kind IS NULL""", _PAGES))
def registry_page_problems(spark, sf_dir):
    pages = _registry_pages(Lens(spark, sf_dir))
    fields = registry_text.page_fields(pages, _MARKER).select(
        "doc_id", "page_no", "anchor", "appendix", "redaction_problem")
    return registry_text.page_problems(registry_text.page_states(fields))


# -- vehicle tables to vehicle rows -----------------------------------------------------------

_VEHICLES = {"vo": """
    SELECT 'V' || o_custkey AS doc, o_custkey % 2 = 1 AS gap, o_orderkey AS k,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS office_seq,
           o_orderkey % 3 AS a, least(o_orderkey % 3, o_orderkey % 2) AS ka, o_orderkey % 4 AS b,
           o_orderkey % 3 + o_orderkey % 4 + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS t
    FROM orders"""}


def _vehicles(lens):
    """Cells of the vehicle tables as read: a customer is a document, an order an office; some totals are off."""
    orders, dealt = (x.select(
        F.concat(F.lit("V"), F.col("o_custkey").cast("string")).alias("doc"), "o_custkey",
        F.col("o_orderkey").alias("k")) for x in (lens.table("orders"), lens.spread("orders", "o_orderkey")))
    k = F.col("k")
    a, b = k % 3, k % 4
    ka = F.least(a, k % 2)
    total = a + b + F.when(k % 13 == 0, 1).otherwise(0)
    number = lambda c: c.cast("string")
    boxed = lambda n, inner: F.concat(number(n), F.lit("\n("), number(inner), F.lit(")"))

    def row(texts):
        return F.explode(F.array(*[
            F.struct(F.lit(c).alias("col_no"), t.alias("text")) for c, t in texts.items()]))

    heads = {1: "事務所", 2: "寝台車\n(うち軽)", 3: "セダン等", 4: "", 5: "合計\n(うち軽)"}
    head = orders.select("doc").distinct().select(
        "doc", F.lit(-1).cast("bigint").alias("row_no"),
        row({c: F.lit(t) for c, t in heads.items()}).alias("x"))
    body = dealt.select("doc", k.alias("row_no"), row({
        1: F.concat(F.lit("Office "), number(k), F.lit("\nTown "), number(k % 50)),
        2: F.when(a > 0, boxed(a, ka)).otherwise(""), 3: number(b), 5: boxed(total, ka)}).alias("x"))
    documents = orders.select("doc", F.when(
        F.col("o_custkey") % 2 == 1, V.GAP_AREA_TYPE).otherwise(V.TRANSPORT_TYPES[0])
        .alias("transport_type")).distinct()
    return vehicle_rows.read_cells(
        head.unionByName(body).select("doc", "row_no", "x.*"), "doc", documents, header_row=-1,
        parts=-(-orders.count() // 50_000))


@R.add("vehicle_rows", with_lenses("""
    SELECT doc, office_seq, 'Office ' || k AS office_name, 'Town ' || (k % 50) AS office_location,
           vehicle_type, vehicle_type_label, n AS count, kei AS count_kei
    FROM (SELECT *, '寝台車' AS vehicle_type, '寝台車(うち軽)' AS vehicle_type_label, a AS n, ka AS kei FROM vo
          UNION ALL SELECT *, CASE WHEN gap THEN '普通自動車' ELSE 'セダン等' END, 'セダン等', b, NULL FROM vo
          UNION ALL SELECT *, '合計', '合計(うち軽)', t, ka FROM vo)
    WHERE n > 0""", _VEHICLES))
def vehicle_rows_query(spark, sf_dir):
    return vehicle_rows.vehicle_rows(_vehicles(Lens(spark, sf_dir)), "doc")


@R.add("vehicle_problems", with_lenses(
    "SELECT doc, office_seq, 'office_total_mismatch' AS reason FROM vo WHERE k % 13 = 0", _VEHICLES))
def vehicle_problems_query(spark, sf_dir):
    return vehicle_rows.vehicle_problems(_vehicles(Lens(spark, sf_dir)), "doc")


# -- the whole operator row -------------------------------------------------------------------

_OFFICES = {
    **_PAGES, **_VEHICLES, "op": _OPERATORS,
    "top_office": """
    SELECT o_custkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq,
           CASE WHEN o_orderkey % 11 = 0 THEN 'Branch ' ELSE 'Office ' END || o_orderkey AS name,
           CASE WHEN o_orderkey % 7 = 0 THEN 'Village' ELSE 'Town ' || (o_orderkey % 50) END AS place
    FROM orders WHERE o_orderkey % 23 <> 0""",
    "top": """
    SELECT k, count(*) AS n, string_agg(name, ';' ORDER BY seq) AS names, string_agg(place, ';' ORDER BY seq) AS places,
           min(seq) FILTER (WHERE name LIKE 'Branch%') AS first_name,
           min(seq) FILTER (WHERE name LIKE 'Office%' AND place = 'Village') AS first_place
    FROM top_office GROUP BY k""",
    "car": """
    SELECT CAST(substr(doc, 2) AS BIGINT) AS k, count(*) AS n, CAST(sum(a + b) AS BIGINT) AS cars,
           CAST(sum(CASE WHEN a > 0 THEN ka ELSE 0 END) AS BIGINT) AS kei FROM vo GROUP BY doc""",
    "area": """
    SELECT doc_id, block_start, string_agg('本郷線 起点 ' || place || '一丁目～終点 県道', chr(10) ORDER BY page_no) AS raw
    FROM st WHERE block_start IS NOT NULL GROUP BY doc_id, block_start"""}


@R.add("operator_rows", with_lenses("""
    SELECT op.* EXCLUDE (k, page_count, problem), 'P' AS pref, replace(raw, '～', '~') AS service_area,
           raw AS service_area_raw, """ + ", ".join(
    f"CAST((k >> {i}) & 1 AS INTEGER) AS {c}" for i, c in enumerate(list(V.SCOPE_COLUMNS.values())[:6])) + """,
           CASE WHEN k % 3 = 0 THEN 0 ELSE CAST((k >> 6) & 1 AS INTEGER) END AS scope_to_other,
           coalesce(names, '') AS office_name, coalesce(places, '') AS office_location,
           '' AS partner_operator_name, '' AS partner_operator_address, coalesce(cars, 0) AS vehicles_total,
           coalesce(kei, 0) AS vehicles_total_kei,
           CASE WHEN coalesce(top.n, 0) <> coalesce(car.n, 0) THEN 'office_mismatch'
                WHEN first_name < first_place THEN 'office_mismatch;office_notation_diff'
                WHEN first_place < first_name THEN 'office_notation_diff;office_mismatch'
                WHEN first_name IS NOT NULL THEN 'office_mismatch'
                WHEN first_place IS NOT NULL THEN 'office_notation_diff' ELSE '' END AS flags
    FROM (SELECT *, CAST(serial_no AS BIGINT) AS k FROM op) op LEFT JOIN top USING (k) LEFT JOIN car USING (k)
    JOIN area ON doc_id = source_pdf AND block_start = source_page""", _OFFICES))
def operator_rows_query(spark, sf_dir):
    """Page texts, passenger box, offices and vehicle table of every operator; a customer is a form, an order an office."""
    lens = Lens(spark, sf_dir)

    def landed(df, name):
        # what several branches read is computed once
        folder = shared_folder(spark, name)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    pages = _registry_pages(lens)
    states = landed(registry_text.page_states(registry_text.page_fields(pages, _MARKER)), "states")

    def keyed(df, k):
        number = F.concat(F.lit("中山市交第"), k.cast("string"), F.lit("号"))
        doc = F.concat(F.lit("D"), F.call_function("div", k, F.lit(8)).cast("string"))
        return df.withColumns({"source_pdf": doc, "registration_no": number})

    k = F.col("c_custkey")
    words = F.array_compact(F.concat(
        F.array(*[F.when(k.bitwiseAND(1 << i) != 0, g) for i, g in enumerate("イロハ二ホヘト")]),
        F.array(F.lit("（イ．身体障害者"), F.when(k % 3 == 0, "その他）"))))
    boxes = keyed(lens.table("customer").withColumn("words", words), k)
    o = F.col("o_orderkey")
    top = ordered.numbered(lens.table("orders").where(o % 23 != 0), ["o_custkey"], "o_orderkey", "office_seq").select(
        "o_custkey", "office_seq",
        F.concat(F.when(o % 11 == 0, "Branch ").otherwise("Office "), o.cast("string")).alias("office_name"),
        F.when(o % 7 == 0, "Village").otherwise(F.concat(F.lit("Town "), (o % 50).cast("string"))).alias("office_location"))
    places = lens.table("nation").select(F.concat("n_name", F.lit("市")).alias("municipality"))
    kinds = pages.select("doc_id").distinct().withColumn("operator_type", F.lit("T"))
    read = landed(_vehicles(lens), "vehicles")
    return operator_rows.operator_rows(
        registry_text.registry_from_text(states, places, kinds), operator_rows.service_areas(states), boxes,
        keyed(top, F.col("o_custkey")), keyed(read, F.expr("substring(doc, 2)").cast("bigint")), "P")
