"""Text-function queries. Japanese inputs are built from integer columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.catalog import Registry
from routeledger.functions import gtfs, policy
from routeledger.functions import text as T
from routeledger.lenses import Lens
from routeledger.operators import compare, scans
from routeledger.session import shared_folder
from routeledger.sources import sinks, tables

R = Registry()

_FULL_SQL = T.FULL_WIDTH[:-2]
_HALF_SQL = T.HALF_WIDTH[:-2].replace("'", "''")
_BLANKS = r"[\s\x0b\x1c-\x1f\p{Z}]"


def _s(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _wide(c):
    return F.translate(c, T.HALF_WIDTH[:-2], T.FULL_WIDTH[:-2])


def _digest(c):
    return F.md5(c.cast("binary"))


@R.add("halfwidth", f"""
    SELECT doc_id, md5(translate(text, '{_FULL_SQL}', '{_HALF_SQL}')) AS digest,
           length(text) AS n_chars
    FROM documents""")
def halfwidth(spark, sf_dir):
    d = Lens(spark, sf_dir).table("documents")
    wide = F.when(F.col("doc_id") % 2 == 0, _wide(F.col("text"))).otherwise(F.col("text"))
    return d.select("doc_id", _digest(T.halfwidth(wide)).alias("digest"),
                    F.length("text").cast("bigint").alias("n_chars"))


_ERA_SQL = "CASE o_orderkey % 3 WHEN 0 THEN 2018 WHEN 1 THEN 1988 ELSE 1925 END"
_ISO_SQL = """printf('%04d-%02d-%02d', {base} + CAST({y} AS INTEGER), CAST({m} AS INTEGER),
                     CAST({d} AS INTEGER))"""


def _era_parts(shift: int):
    k = F.col("o_orderkey")
    era = F.element_at(F.array(*map(F.lit, ("令和", "平成", "昭和"))), (k % 3 + 1).cast("int"))
    abbr = F.element_at(F.array(*map(F.lit, ("R", "H", "S"))), (k % 3 + 1).cast("int"))
    y, m, d = 1 + k % 9 + shift, 1 + k % 12, 1 + k % 28
    full = F.concat(era, _s(y), F.lit("年"), _s(m), F.lit("月"), _s(d), F.lit("日"))
    short = F.concat(abbr, F.concat_ws(".", _s(y), _s(m), _s(d)))
    return full, short


def _iso_sql(shift: int) -> str:
    return _ISO_SQL.format(base=_ERA_SQL, y=f"1 + o_orderkey % 9 + {shift}",
                           m="1 + o_orderkey % 12", d="1 + o_orderkey % 28")


@R.add("wareki_dates", f"SELECT o_orderkey, {_iso_sql(0)} AS iso_date FROM orders")
def wareki_dates(spark, sf_dir):
    full, short = _era_parts(0)
    src = F.when(F.col("o_orderkey") % 2 == 0, _wide(full)).otherwise(short)
    return Lens(spark, sf_dir).table("orders").select(
        "o_orderkey", T.era_date(src).alias("iso_date"))


@R.add("wareki_ranges", f"""
    SELECT o_orderkey, f <> 3 AS readable,
           CASE WHEN f = 2 THEN {_iso_sql(-1)} WHEN f <> 3 THEN '' END AS registered_date,
           CASE WHEN f <> 3 THEN {_iso_sql(0)} END AS renewed_date,
           CASE WHEN f <> 3 THEN {_iso_sql(0)} END AS valid_from,
           CASE WHEN f <> 3 THEN {_iso_sql(3)} END AS valid_to
    FROM (SELECT *, o_orderkey % 4 AS f FROM orders)""")
def wareki_ranges(spark, sf_dir):
    (f0, a0), (f1, a1), (_, ap) = _era_parts(0), _era_parts(3), _era_parts(-1)
    form = F.col("o_orderkey") % 4
    src = (
        F.when(form == 0, F.concat(f0, F.lit("～"), f1))
        .when(form == 1, F.concat(_wide(a0), F.lit("〜 "), a1))
        .when(form == 2, F.concat(F.lit("登録年月日："), ap, F.lit("\n更新登録年月日："), a0,
                                  F.lit("～"), a1))
        .otherwise(F.concat(F.lit("有効期間 "), f0)))
    d = T.registration_dates(F.col("src"))
    return (
        Lens(spark, sf_dir).table("orders").select("o_orderkey", src.alias("src"))
        .select("o_orderkey", d.alias("d"))
        .select("o_orderkey", F.col("d").isNotNull().alias("readable"), "d.registered_date",
                "d.renewed_date", "d.valid_from", "d.valid_to"))


@R.add("registration_parse", """
    SELECT s_suppkey,
           CASE WHEN s_suppkey % 5 <> 4 THEN prefix || code || '第' || s_suppkey || '号' END
               AS registration_no,
           CASE WHEN s_suppkey % 5 = 4 THEN NULL WHEN prefix = '中山市' THEN '中山'
                ELSE prefix END AS authority_code,
           CASE WHEN s_suppkey % 5 <> 4 THEN code END AS service_type_code,
           CASE WHEN s_suppkey % 5 <> 4 THEN CAST(s_suppkey AS VARCHAR) END AS serial_no
    FROM (SELECT s_suppkey, ['中山', '中山市', '神戸市'][CAST(s_suppkey % 3 + 1 AS INTEGER)]
                 AS prefix, ['福', '交', '過'][CAST(s_suppkey % 7 % 3 + 1 AS INTEGER)] AS code
          FROM supplier)""")
def registration_parse(spark, sf_dir):
    k = F.col("s_suppkey")
    pick = lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (i + 1).cast("int"))
    raw = F.concat(pick(("中山", "中山市", "神戸市"), k % 3), F.lit(" "),
                   pick(("福", "交", "過"), k % 7 % 3), F.lit("第　"), _wide(_s(k)),
                   F.when(k % 5 == 4, "番").otherwise(" 号"))
    return (
        Lens(spark, sf_dir).table("supplier")
        .select("s_suppkey", T.registration_parts(raw).alias("r"))
        .select("s_suppkey", "r.registration_no", "r.authority_code", "r.service_type_code",
                "r.serial_no"))


@R.add("compare_key", f"""
    SELECT doc_id, md5(regexp_replace(translate(text, '{_FULL_SQL}', '{_HALF_SQL}'),
                                      '{_BLANKS}+', '', 'g')) AS digest
    FROM documents""")
def compare_key(spark, sf_dir):
    return Lens(spark, sf_dir).table("documents").select(
        "doc_id", _digest(T.compare_key(F.col("text"))).alias("digest"))


@R.add("unwrap_cell", f"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{_BLANKS}*\\n{_BLANKS}*', '', 'g'),
                                      '^{_BLANKS}+|{_BLANKS}+$', '', 'g')) AS digest
    FROM documents""")
def unwrap_cell(spark, sf_dir):
    return Lens(spark, sf_dir).table("documents").select(
        "doc_id", _digest(T.unwrap_cell(F.col("text"))).alias("digest"))


@R.add("area_prefix", """
    SELECT c_custkey, CASE WHEN c_custkey % 6 = 5 THEN ''
           ELSE 'N' || c_nationkey || '市;M' || (c_custkey % 7) || '町' END AS municipalities
    FROM customer""")
def area_prefix(spark, sf_dir):
    k = F.col("c_custkey")
    src = F.when(k % 6 == 5, F.lit("離島（和木町）")).otherwise(F.concat(
        F.lit("Ｎ"), _s("c_nationkey"), F.lit("市、M"), _s(k % 7), F.lit("町全域（Q市の一部）")))
    return Lens(spark, sf_dir).table("customer").select(
        "c_custkey", F.array_join(T.area_prefix(src), ";").alias("municipalities"))


@R.add("area_roster", """
    SELECT s_suppkey, coalesce(string_agg(name, ';' ORDER BY pos, name), '') AS municipalities
    FROM (SELECT s_suppkey, area, org FROM (
              SELECT s_suppkey, n2.n_name || '市と' || n1.n_name || '市' ||
                     CASE WHEN s_suppkey % 4 = 1 THEN '向津具地区' ELSE '' END AS area,
                     CASE WHEN s_suppkey % 3 = 0 THEN s_name || '村' ELSE s_name END AS org
              FROM supplier JOIN nation n1 ON n1.n_nationkey = s_nationkey
                            JOIN nation n2 ON n2.n_nationkey = s_suppkey % 25))
    LEFT JOIN LATERAL (
        SELECT instr(area, n_name || '市') AS pos, n_name || '市' AS name
        FROM nation WHERE contains(area, n_name || '市')
        UNION ALL SELECT instr(area, '向津具地区'), '長門市' WHERE contains(area, '向津具地区')
        UNION ALL SELECT -1, org WHERE org LIKE '%村') ON true
    GROUP BY s_suppkey""")
def area_roster(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    nation = lens.table("nation")
    n1 = nation.select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("n1"))
    n2 = nation.select(F.col("n_nationkey").alias("b"), F.col("n_name").alias("n2"))
    k = F.col("s_suppkey")
    areas = (
        lens.table("supplier")
        .join(n1, F.col("s_nationkey") == F.col("a")).join(n2, k % 25 == F.col("b"))
        .select(
            "s_suppkey",
            F.concat("n2", F.lit("市と"), "n1", F.lit("市"),
                     F.when(k % 4 == 1, "向津具地区").otherwise("")).alias("area"),
            F.when(k % 3 == 0, F.concat("s_name", F.lit("村"))).otherwise(F.col("s_name"))
            .alias("org")))
    roster = nation.select(F.concat("n_name", F.lit("市")).alias("municipality"))
    return scans.area_roster(areas, "s_suppkey", "area", "org", roster)


# -- timetable cells --------------------------------------------------------------------------


@R.add("gtfs_time_seconds", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
           CASE WHEN l_linenumber = 7 OR l_partkey % 61 = 60 THEN NULL
                ELSE CAST((l_partkey % 130) * 3600 + (l_partkey % 61) * 60 + l_suppkey % 60
                          AS INTEGER) END AS seconds
    FROM lineitem""")
def gtfs_time_seconds(spark, sf_dir):
    two = lambda c: F.lpad(_s(c), 2, "0")
    src = F.concat_ws(":", _s(F.col("l_partkey") % 130), two(F.col("l_partkey") % 61),
                      two(F.col("l_suppkey") % 60))
    src = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("+"), src)).otherwise(src)
    return Lens(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        gtfs.gtfs_seconds(src).alias("seconds"))


@R.add("positive_int", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
           CASE WHEN l_linenumber < 5 AND l_partkey % 100 > 0 THEN l_partkey % 100 END AS n
    FROM lineitem""")
def positive_int(spark, sf_dir):
    v = _s(F.col("l_partkey") % 100)
    src = (F.when(F.col("l_linenumber") == 5, F.concat(v, F.lit(".0")))
           .when(F.col("l_linenumber") == 6, F.concat(F.lit("-"), v))
           .when(F.col("l_linenumber") == 7, F.lit(""))
           .otherwise(F.concat(F.lit("0"), v)))
    return Lens(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", gtfs.positive_int(src).alias("n"))


@R.add("gtfs_date_valid", """
    SELECT o_orderkey, o_orderkey % 10 <> 9 AND try_strptime(printf('%04d%02d%02d',
           CAST(1990 + o_orderkey % 40 AS INTEGER), CAST(o_orderkey % 14 AS INTEGER),
           CAST(o_orderkey % 33 AS INTEGER)), '%Y%m%d') IS NOT NULL AS is_valid
    FROM orders""")
def gtfs_date_valid(spark, sf_dir):
    k = F.col("o_orderkey")
    src = F.format_string("%04d%02d%02d", 1990 + k % 40, k % 14, k % 33)
    src = F.when(k % 10 == 9, F.concat(F.lit(" "), src)).otherwise(src)
    return Lens(spark, sf_dir).table("orders").select(
        "o_orderkey", gtfs.gtfs_date(src).isNotNull().alias("is_valid"))


# -- registry cells ---------------------------------------------------------------------------


@R.add("cell_value", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
           CASE WHEN f = 4 THEN 0 ELSE q END AS total,
           CASE WHEN f = 5 THEN NULL WHEN f IN (0, 2) THEN CAST(l_partkey % 5 AS INTEGER)
                ELSE 0 END AS inner_count
    FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q, l_linenumber % 6 AS f FROM lineitem)""")
def cell_value(spark, sf_dir):
    q, k = _s(F.col("l_quantity").cast("int")), _s(F.col("l_partkey") % 5)
    form = F.col("l_linenumber") % 6
    src = (F.when(form == 0, F.concat(q, F.lit("\n（ "), k, F.lit(" ）")))
           .when(form == 1, F.concat(_wide(q), F.lit("\n( )")))
           .when(form == 2, F.concat(q, F.lit("\n"), k))
           .when(form == 4, F.lit(" \n"))
           .otherwise(q))
    keys = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
    return (
        Lens(spark, sf_dir).table("lineitem").select(*keys, src.alias("src"), form.alias("form"))
        .select(*keys, T.cell_value(F.col("src"), F.col("form") != 5).alias("v"))
        .select(*keys, F.col("v.total").alias("total"), F.col("v.inner").alias("inner_count")))


@R.add("label_map", """
    SELECT p_partkey, CASE p_partkey % 8
           WHEN 0 THEN '寝台車' WHEN 1 THEN '車いす車' WHEN 2 THEN '兼用車'
           WHEN 3 THEN '回転シート車'
           WHEN 4 THEN CASE WHEN p_size % 2 = 0 THEN '普通自動車' ELSE 'セダン等' END
           WHEN 5 THEN 'バス' WHEN 6 THEN '合計' END AS vehicle_type
    FROM part""")
def label_map(spark, sf_dir):
    labels = ("寝台車(軽)", "車いす\n車(軽)", "兼用車", "回転シート\n車", "セダン 等(軽)", "バス",
              "合 計(軽)", "その他")
    label = F.element_at(F.array(*map(F.lit, labels)), (F.col("p_partkey") % 8 + 1).cast("int"))
    kind = F.when(F.col("p_size") % 2 == 0, V.TRANSPORT_TYPES[1]).otherwise(V.TRANSPORT_TYPES[0])
    return Lens(spark, sf_dir).table("part").select(
        "p_partkey", T.vehicle_type(label, kind).alias("vehicle_type"))


@R.add("scope_flags", "SELECT s_suppkey, " + ", ".join(
    f"CAST((s_suppkey >> {i}) & 1 AS INTEGER) AS {c}"
    for i, c in enumerate(list(V.SCOPE_COLUMNS.values())[:6])
) + """, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE CAST((s_suppkey >> 6) & 1 AS INTEGER) END
        AS scope_to_other FROM supplier""")
def scope_flags(spark, sf_dir):
    k = F.col("s_suppkey")
    glyphs = "イロハ二ホヘト"
    words = F.array_compact(F.concat(
        F.array(*[F.when(k.bitwiseAND(1 << i) != 0, g) for i, g in enumerate(glyphs)]),
        F.array(F.lit("（イ．身体障害者"), F.when(k % 3 == 0, "その他）"))))
    return Lens(spark, sf_dir).table("supplier").select(
        "s_suppkey", *T.scope_flags(words).values())


@R.add("redact_lines", f"""
    SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 0 WHEN doc_id % 4 = 2 THEN 2 ELSE 1 END
               AS matched,
           CASE doc_id % 4 WHEN 1 THEN 'empty_value' WHEN 2 THEN 'count_mismatch' END AS problem,
           md5(CASE WHEN doc_id % 4 = 3 THEN text
                    WHEN doc_id % 4 = 2 THEN text || '\n' || m || '\n' || m
                    ELSE text || '\n' || m END) AS digest
    FROM (SELECT *, '{V.REDACTION_LABEL} {V.REDACTION_MARKER}' AS m FROM documents)""")
def redact_lines(spark, sf_dir):
    k = F.col("doc_id") % 4
    line = F.concat(F.lit(f"\n{V.REDACTION_LABEL} 理事長 "), F.col("source"))
    src = (F.when(k == 3, F.col("text")).when(k == 2, F.concat("text", line, line))
           .when(k == 1, F.concat("text", F.lit(f"\n{V.REDACTION_LABEL}　")))
           .otherwise(F.concat("text", line)))
    r = T.redact_lines(F.col("src"), V.REDACTION_LABEL, V.REDACTION_MARKER, F.col("k") != 3)
    return (
        Lens(spark, sf_dir).table("documents")
        .select("doc_id", src.alias("src"), k.alias("k"))
        .select("doc_id", r.alias("r"))
        .select("doc_id", "r.matched", "r.problem", _digest(F.col("r.text")).alias("digest")))


@R.add("newline_norm", """
    SELECT doc_id, md5(text) AS digest, contains(text, '\n') AS had_crlf FROM documents""")
def newline_norm(spark, sf_dir):
    crlf = F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n"))
    return Lens(spark, sf_dir).table("documents").select(
        "doc_id", _digest(T.newline_norm(crlf)).alias("digest"),
        crlf.contains("\r\n").alias("had_crlf"))


@R.add("utf8_status", """
    SELECT doc_id, doc_id % 3 = 1 AS had_bom, doc_id % 5 = 2 AS decode_error,
           CASE WHEN doc_id % 5 <> 2 THEN md5(text) END AS digest FROM documents""")
def utf8_status(spark, sf_dir):
    from routeledger.sources.decode import strict_utf8
    k, body = F.col("doc_id"), F.encode("text", "UTF-8")
    raw = F.concat(F.when(k % 3 == 1, F.lit(b"\xef\xbb\xbf")).otherwise(F.lit(b"")), body,
                   F.when(k % 5 == 2, F.lit(b"\x93\xfa")).otherwise(F.lit(b"")))
    return (
        Lens(spark, sf_dir).table("documents").select("doc_id", strict_utf8(raw).alias("u"))
        .select("doc_id", "u.had_bom", "u.decode_error", _digest(F.col("u.text")).alias("digest")))


@R.add("doc_fingerprint", """
    SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS sha256 FROM documents""")
def doc_fingerprint(spark, sf_dir):
    raw = F.encode("text", "UTF-8")
    return Lens(spark, sf_dir).table("documents").select(
        "doc_id", F.octet_length(raw).cast("bigint").alias("n_bytes"),
        F.sha2(raw, 256).alias("sha256"))


@R.add("name_key", f"""
    SELECT p_partkey, lower(p_name) || '-' || lower(p_brand) AS name_key FROM part""")
def name_key(spark, sf_dir):
    src = F.concat_ws("-", _wide(F.upper("p_name")), F.col("p_brand"))
    return Lens(spark, sf_dir).table("part").select(
        "p_partkey", policy.name_key(src).alias("name_key"))


_URL_SQL = """
    SELECT page_id, CASE page_id % 8
               WHEN 0 THEN replace(u, '://', '://user:pw@') WHEN 1 THEN replace(u, '.test/', '.test:8443/')
               WHEN 2 THEN replace(u, '.test/', '.test:443/') WHEN 3 THEN replace(u, '.test/', '.test:x/')
               ELSE u END AS url
    FROM (SELECT page_id, regexp_replace(CASE WHEN page_id % 3 = 0 THEN url
                 ELSE replace(url, 'http://', 'https://') END, '://[^/]*', CASE
                 WHEN page_id % 5 = 4 THEN '://other.test' ELSE '://open.test' END) AS u
          FROM pages)"""


def _urls(lens):
    k = F.col("page_id")
    u = F.when(k % 3 == 0, F.col("url")).otherwise(
        F.replace("url", F.lit("http://"), F.lit("https://")))
    u = F.when(k % 5 == 4, F.regexp_replace(u, "://[^/]*", "://other.test")).otherwise(
        F.regexp_replace(u, "://[^/]*", "://open.test"))
    swap = lambda a, b: F.replace(F.col("u"), F.lit(a), F.lit(b))
    form = k % 8
    return lens.table("pages").select("page_id", u.alias("u")).select(
        "page_id",
        F.when(form == 0, swap("://", "://user:pw@")).when(form == 1, swap(".test/", ".test:8443/"))
        .when(form == 2, swap(".test/", ".test:443/")).when(form == 3, swap(".test/", ".test:x/"))
        .otherwise(F.col("u")).alias("url"))


@R.add("url_policy", f"""
    SELECT page_id, url, CASE
        WHEN url LIKE '%.test:x/%' THEN 'url_parse_error'
        WHEN url NOT LIKE 'https://%' THEN 'https_required'
        WHEN NOT regexp_matches(url, '^https://([^@/]*@)?open\\.test') THEN 'host_not_allowed'
        WHEN regexp_matches(url, '^https://[^/]*@') THEN 'userinfo_not_allowed'
        WHEN url LIKE '%.test:8443/%' THEN 'port_not_allowed'
        WHEN url LIKE '%?%' THEN 'query_not_allowed'
        WHEN url LIKE '%#%' THEN 'fragment_not_allowed' END AS reason
    FROM ({_URL_SQL})""")
def url_policy(spark, sf_dir):
    return _urls(Lens(spark, sf_dir)).select(
        "page_id", "url", policy.url_reason(F.col("url"), ["open.test"]).alias("reason"))


@R.add("path_policy", """
    SELECT page_id, [NULL, 'directory', 'parent_reference', 'absolute_path', 'drive_name',
                     'backslash', 'empty_name'][CAST(page_id % 7 + 1 AS INTEGER)]
                    AS member_reason,
           ['local_path_must_be_under_raw', NULL, 'local_path_traversal', 'local_path_traversal',
            'local_path_must_be_under_raw', 'local_path_must_use_posix_separators',
            'local_path_traversal'][CAST(page_id % 7 + 1 AS INTEGER)] AS local_reason
    FROM pages""")
def path_policy(spark, sf_dir):
    leaf = F.concat(F.regexp_replace("url", "[^A-Za-z0-9.]+", "_"), F.lit(".txt"))
    k = F.col("page_id") % 7
    path = F.when(k == 6, F.lit("")).otherwise(F.concat(
        F.element_at(F.array(*map(F.lit, ("", "raw/", "raw/../", "/", "C:", "a\\", ""))),
                     (k + 1).cast("int")), leaf))
    return Lens(spark, sf_dir).table("pages").select(
        "page_id", policy.member_name_reason(path).alias("member_reason"),
        policy.local_path_reason(path).alias("local_reason"))


# -- scans ------------------------------------------------------------------------------------


@R.add("secret_scan", r"""
    SELECT doc_id, CAST(len(regexp_extract_all(t, 'eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+'))
                        AS INTEGER) AS token_count,
           md5(CASE WHEN doc_id % 10 = 0 THEN text || ' key ' || 'REDACTED_TOKEN_SHA256_' ||
                    sha256(tok) || '_LEN_' || length(tok) || '.' ELSE text END) AS digest
    FROM (SELECT *, CASE WHEN doc_id % 10 = 0 THEN text || ' key ' || tok || '.' ELSE text END AS t
          FROM (SELECT *, 'eyJ' || doc_id || '.a_b-' || source || '.c' || lang AS tok
                FROM documents))""")
def secret_scan(spark, sf_dir):
    tok = F.concat(F.lit("eyJ"), _s("doc_id"), F.lit(".a_b-"), "source", F.lit(".c"), "lang")
    src = F.when(F.col("doc_id") % 10 == 0,
                 F.concat("text", F.lit(" key "), tok, F.lit("."))).otherwise(F.col("text"))
    return (
        Lens(spark, sf_dir).table("documents").select("doc_id", src.alias("t"))
        .select("doc_id", F.size(T.secret_tokens(F.col("t"))).alias("token_count"),
                _digest(T.redact_tokens(F.col("t"))).alias("digest")))


@R.add("leak_scan", """
    SELECT doc_id, item_id
    FROM (SELECT doc_id, regexp_replace(text, '[ \t　]+', '', 'g') AS hay FROM documents)
    JOIN (SELECT item_id, regexp_replace(text, '[ \t　]+', '', 'g') AS needle FROM benchmark)
      ON needle <> '' AND contains(hay, needle)""")
def leak_scan(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return scans.leak_scan(lens.table("documents"), "doc_id", "text",
                           lens.table("benchmark"), "item_id", "text")


@R.add("format_equiv", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CASE WHEN side = 'left_only' AND c_custkey % 50 = 7 THEN ''
                ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey, side, CAST(1 AS BIGINT) AS n
    FROM customer, (SELECT unnest(['left_only', 'right_only']) AS side)
    WHERE c_custkey % 50 = 7 OR (c_custkey % 50 = 9 AND side = 'left_only')""")
def format_equiv(spark, sf_dir):
    """CSV-like copy (blank cells, one field lost) against a JSON-like copy (a row lost)."""
    c = Lens(spark, sf_dir).table("customer").select("c_custkey", "c_name", "c_nationkey")
    k = F.col("c_custkey") % 50
    left = c.withColumn("c_nationkey", F.when(k != 7, F.col("c_nationkey")))
    right = c.where(k != 9)
    return compare.multiset_diff(compare.as_text(left), compare.as_text(right))


@R.add("publish_readback_diff", """
    SELECT o_orderkey, o_orderstatus, side, CAST(1 AS BIGINT) AS n FROM (
        SELECT o_orderkey, o_orderstatus, 'left_only' AS side FROM orders
        WHERE o_orderkey % 1000 IN (998, 999)
        UNION ALL SELECT o_orderkey, '?', 'right_only' FROM orders WHERE o_orderkey % 1000 = 999)""")
def publish_readback_diff(spark, sf_dir):
    """Source against a published copy that lost some rows and changed others."""
    o = Lens(spark, sf_dir).table("orders").select("o_orderkey", "o_orderstatus")
    k = F.col("o_orderkey") % 1000
    copy = o.where(k != 998).withColumn(
        "o_orderstatus", F.when(k == 999, "?").otherwise(F.col("o_orderstatus")))
    return compare.multiset_diff(o, copy)


@R.add("csv_roundtrip", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(coalesce(text, '')) AS digest, coalesce(source, '') AS source,
           coalesce(lang, '') AS lang FROM documents""")
def csv_roundtrip(spark, sf_dir):
    """Whole texts, line ends and quotes included, written as ordered CSV and read back in splits."""
    path, columns = shared_folder(spark, "csv"), ["doc_id", "text", "source", "lang"]
    sinks.write_csv(Lens(spark, sf_dir).table("documents"), path, columns, ["doc_id"])
    back = tables.read_quoted_csv(spark, path, columns)
    return back.select("doc_id", _digest(F.col("text")).alias("digest"), "source", "lang")


@R.add("json_roundtrip", """
    SELECT page_id, md5(html) AS digest, CASE WHEN page_id % 3 <> 0 THEN url END AS url FROM pages""")
def json_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "json")
    url = F.when(F.col("page_id") % 3 != 0, F.col("url")).alias("url")
    sinks.write_json(Lens(spark, sf_dir).table("pages").select("page_id", "html", url), path,
                     ["page_id", "html", "url"], ["page_id"])
    back = tables.read_json_records(spark, path, "page_id bigint, html string, url string", lines=True)
    return back.select("page_id", _digest(F.col("html")).alias("digest"), "url")


@R.add("publish_versions", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders
    WHERE o_orderkey % 5 <> 4""")
def publish_versions(spark, sf_dir):
    """Two versions published one after the other, and a third that is refused: the second is what readers see."""
    path = shared_folder(spark, "published")
    o = Lens(spark, sf_dir).table("orders").select("o_orderkey", "o_orderstatus")
    none = o.where("o_orderkey < 0")
    sinks.publish(o, path, none)
    status = F.when(F.col("o_orderkey") % 2 == 0, "X").otherwise(F.col("o_orderstatus"))
    sinks.publish(o.where("o_orderkey % 5 <> 4").withColumn("o_orderstatus", status), path, none)
    try:
        sinks.publish(o, path, none, "0:0")
    except sinks.PublishError:
        pass
    return sinks.published(spark, path)


_MD = "'## ' || source || ' part\n`' || lang || '_x` and `y`\n| n' || doc_id || ' | v |\n|---|---|\n```\n' || text || '\n```\n'"


@R.add("token_coverage", f"""
    WITH md AS (SELECT doc_id, source, lang, text, {_MD} AS body FROM documents),
    pair AS (
        SELECT o.doc_id, o.source, o.lang, o.text,
               coalesce(n.body, o.body) || '\n### 改訂点\n' || split_part(o.text, '\n', 1) AS new_text,
               split_part(o.text, '\n', 1) AS notes
        FROM md o LEFT JOIN md n ON n.doc_id = o.doc_id + 1),
    tok AS (
        SELECT doc_id, 'heading' AS kind, source || ' part' AS t FROM pair
        UNION ALL SELECT doc_id, 'identifier', lang || '_x' FROM pair
        UNION ALL SELECT doc_id, 'table_first_column', 'n' || doc_id FROM pair
        UNION ALL SELECT DISTINCT doc_id, 'code_line', l FROM (
            SELECT doc_id, regexp_replace(unnest(string_split(text, '\n')),
                                          '^{_BLANKS}+|{_BLANKS}+$', '', 'g') AS l FROM pair)
        WHERE length(l) >= 4),
    hit AS (
        SELECT kind, contains(nn, k) AS present, contains(rr, k) AS explained
        FROM (SELECT doc_id, kind, regexp_replace(t, '{_BLANKS}+', '', 'g') AS k FROM tok)
        JOIN (SELECT doc_id, regexp_replace(new_text, '{_BLANKS}+', '', 'g') AS nn,
                     regexp_replace('###改訂点' || notes, '{_BLANKS}+', '', 'g') AS rr FROM pair)
        USING (doc_id))
    SELECT kind, count(*) AS total, count(*) FILTER (WHERE present) AS present,
           count(*) FILTER (WHERE NOT present AND explained) AS explained,
           count(*) FILTER (WHERE NOT present AND NOT explained) AS missing
    FROM hit GROUP BY kind""")
def token_coverage(spark, sf_dir):
    body = F.concat(F.lit("## "), "source", F.lit(" part\n`"), "lang", F.lit("_x` and `y`\n| n"),
                    _s("doc_id"), F.lit(" | v |\n|---|---|\n```\n"), "text", F.lit("\n```\n"))
    docs = Lens(spark, sf_dir).table("documents").select("doc_id", "text", body.alias("body"))
    new = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("body").alias("next"))
    first_line = F.get(F.split("text", "\n"), F.lit(0))
    pairs = docs.join(new, "doc_id", "left").select(
        F.col("body").alias("old"),
        F.concat(F.coalesce("next", "body"), F.lit("\n### 改訂点\n"), first_line).alias("new"))
    return scans.token_coverage(pairs, "old", "new", "改訂点")
