"""Access, hand-off, provenance, score, contract and streaming queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.catalog import Registry
from routeledger.catalog import registry as reg
from routeledger.catalog.timetable import _VERDICT
from routeledger.lens_sql import with_lenses
from routeledger.lenses import Lens
from routeledger.operators import access, contracts, provenance, score
from routeledger.operators import registry as registry_ops
from routeledger.plans import feed_metrics as fm
from routeledger.session import shared_folder
from routeledger.streaming import freshness

R = Registry()
_S = list(V.ACCESS_STATUSES)
_STATES_SQL = "['" + "', '".join(_S) + "']"

# -- access -----------------------------------------------------------------------------------

ACCESS = {
    "places": "SELECT c_custkey AS roster_ord, c_name AS municipality FROM customer",
    "status": f"""
        SELECT c_custkey, CASE WHEN c_custkey % 40 = 3 THEN 'Unlisted ' || c_custkey ELSE c_name END
               AS municipality,
               CASE WHEN c_custkey % 60 = 7 THEN 'unclear'
                    ELSE {_STATES_SQL}[CAST(c_custkey % 4 + 1 AS INTEGER)] END
                   AS availability_status,
               CASE WHEN c_custkey % 45 = 8 THEN '' WHEN c_custkey % 50 = 9 THEN 'S-gone'
                    ELSE 'S' || c_nationkey % 10 || CASE WHEN c_custkey % 3 = 0
                         THEN ';S' || (c_custkey % 7) ELSE '' END END AS feed_ids
        FROM customer""",
    "feed_list": """
        SELECT 'S' || s_suppkey AS feed_id FROM supplier
        UNION ALL SELECT 'S' || s_suppkey FROM supplier WHERE s_suppkey % 20 = 4""",
    "bridge": """
        SELECT municipality, f AS feed_id FROM (
            SELECT municipality, unnest(string_split(feed_ids, ';')) AS f FROM status)
        WHERE f <> ''""",
}


def _sql(query, extra=None):
    return reg.sql(query, {**ACCESS, **(extra or {})})


def _places(lens):
    return lens.table("customer").select(
        F.col("c_custkey").alias("roster_ord"), F.col("c_name").alias("municipality"))


def _pick(values, index):
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _status(lens):
    k = F.col("c_custkey")
    text = lambda c: c.cast("string")
    feeds = (
        F.when(k % 45 == 8, "").when(k % 50 == 9, "S-gone")
        .otherwise(F.concat(F.lit("S"), text(F.col("c_nationkey") % 10), F.when(
            k % 3 == 0, F.concat(F.lit(";S"), text(k % 7))).otherwise(""))))
    return lens.table("customer").select(
        F.when(k % 40 == 3, F.concat(F.lit("Unlisted "), text(k))).otherwise(F.col("c_name"))
        .alias("municipality"),
        F.when(k % 60 == 7, "unclear").otherwise(_pick(_S, k % 4)).alias("availability_status"),
        feeds.alias("feed_ids"))


def _feed_list(lens):
    s = lens.table("supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("feed_id"), "s_suppkey")
    return s.unionByName(s.where(F.col("s_suppkey") % 20 == 4)).select("feed_id")


@R.add("roster_equality", _sql("""
    SELECT coalesce(p.municipality, s.municipality) AS municipality,
           CASE WHEN p.municipality IS NULL THEN 'not_in_roster' ELSE 'missing_status' END AS problem
    FROM places p FULL JOIN status s ON s.municipality = p.municipality
    WHERE p.municipality IS NULL OR s.municipality IS NULL"""))
def roster_equality(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return access.roster_equality(_places(lens), _status(lens))


@R.add("bridge_violations", _sql("""
    SELECT 'unknown_status' AS rule_id, municipality AS entity, availability_status AS detail
    FROM status WHERE availability_status = 'unclear'
    UNION ALL SELECT 'empty_feed_list', municipality, '' FROM status WHERE feed_ids = ''
    UNION ALL SELECT DISTINCT 'unknown_feed', municipality, feed_id
              FROM bridge ANTI JOIN feed_list USING (feed_id)
    UNION ALL SELECT 'duplicate_feed_id', feed_id, '' FROM feed_list
              GROUP BY feed_id HAVING count(*) > 1"""))
def bridge_violations(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return access.bridge_violations(_status(lens), _feed_list(lens))


@R.add("municipality_access", _sql("""
    SELECT roster_ord, municipality, availability_status, feed_ids,
           coalesce(n, 0) AS feed_count, coalesce(known, 0) AS known_feed_count
    FROM places LEFT JOIN status USING (municipality) LEFT JOIN (
        SELECT municipality, count(*) AS n, count(k) AS known FROM bridge
        LEFT JOIN (SELECT DISTINCT feed_id, 1 AS k FROM feed_list) USING (feed_id)
        GROUP BY municipality) USING (municipality)"""))
def municipality_access(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    return access.municipality_access(_places(lens), _status(lens), _feed_list(lens))


@R.add("access_state_counts", _sql(f"""
    SELECT s AS availability_status, count(municipality) AS n
    FROM (SELECT unnest({_STATES_SQL}) AS s) LEFT JOIN status ON availability_status = s
    GROUP BY s"""))
def access_state_counts(spark, sf_dir):
    return access.access_state_counts(_status(Lens(spark, sf_dir)))


_FEED_OF = """
        SELECT c_name AS municipality, 'F' || (c_custkey % 4) || CASE WHEN c_custkey % 5 = 0
               THEN ';F' || ((c_custkey + 1) % 4) ELSE '' END AS feed_ids FROM customer"""


@R.add("metrics_by_municipality_ref", with_lenses("""
    SELECT municipality, feed_id, metric_id, value, metric_status,
           'whole_feed' AS measurement_scope
    FROM (SELECT municipality, unnest(string_split(feed_ids, ';')) AS feed_id FROM feed_of)
    JOIN structure USING (feed_id)""", {**_VERDICT, "feed_of": _FEED_OF}))
def metrics_by_municipality_ref(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    k = F.col("c_custkey")
    f = lambda c: F.concat(F.lit("F"), (c % 4).cast("string"))
    status = lens.table("customer").select(
        F.col("c_name").alias("municipality"),
        F.concat_ws(";", f(k), F.when(k % 5 == 0, f(k + 1))).alias("feed_ids"))
    return access.metrics_by_municipality(fm.structure_metrics(lens.feed_tables()), status)


_NATION_STATUS = {
    "nstatus": f"""
        SELECT n_name AS municipality,
               {_STATES_SQL}[CAST(n_nationkey % 4 + 1 AS INTEGER)] AS availability_status,
               'F' || (n_regionkey % 4) AS feed_ids, n_nationkey FROM nation""",
    "supply": """
        SELECT municipality, count(s_suppkey) AS operator_count
        FROM roster LEFT JOIN op_area USING (municipality) GROUP BY municipality""",
}


def _nation_status(lens):
    return lens.table("nation").select(
        F.col("n_name").alias("municipality"),
        _pick(_S, F.col("n_nationkey") % 4).alias("availability_status"),
        F.concat(F.lit("F"), (F.col("n_regionkey") % 4).cast("string")).alias("feed_ids"))


@R.add("handoff_crosstab", _sql("""
    SELECT CASE WHEN operator_count > 0 THEN 'registered' ELSE 'no-registry' END AS registry_state,
           availability_status, count(*) AS n
    FROM supply JOIN nstatus USING (municipality) GROUP BY 1, 2""", _NATION_STATUS))
def handoff_crosstab(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    supply = registry_ops.municipal_supply(reg.operators(lens), reg.roster(lens))
    return access.handoff_crosstab(supply, _nation_status(lens))


@R.add("handoff_memo", _sql("""
    SELECT municipality, registry_state, availability_status, has_metrics, handoff_state,
           unnest([0, 1, 2, 3]) AS item_no,
           unnest(['recheck_number_expiry_and_area_in_source',
                   CASE WHEN operator_count > 0 THEN 'check_expiry_and_overlap_do_not_sum'
                        ELSE 'zero_is_not_absence_collect_more_sources' END,
                   CASE WHEN confirmed THEN 'recheck_official_distribution_and_scope'
                        ELSE 'recheck_catalogue_and_operators_no_absence_claim' END,
                   CASE WHEN has_metrics THEN 'check_week_date_and_whole_feed_unit'
                        ELSE 'accept_feed_before_filling_values' END]) AS item
    FROM (SELECT *, registry_state || '/' || CASE WHEN confirmed THEN 'gtfs-confirmed'
                    ELSE 'gtfs-unconfirmed' END AS handoff_state
          FROM (SELECT municipality, operator_count, availability_status,
                       CASE WHEN operator_count > 0 THEN 'registered' ELSE 'no-registry' END
                           AS registry_state,
                       availability_status = 'public_download_confirmed' AS confirmed,
                       coalesce(feed_ids IN (SELECT feed_id FROM metrics
                           WHERE metric_id = 'scheduled_trip_count_by_date'
                             AND metric_status = 'measured'), false) AS has_metrics
                FROM supply JOIN nstatus USING (municipality)))""",
    {**_VERDICT, **_NATION_STATUS}))
def handoff_memo(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    from routeledger.lenses import WEEK
    supply = registry_ops.municipal_supply(reg.operators(lens), reg.roster(lens))
    t = lens.feed_tables()
    measured = fm.daily_metrics(fm.feed_checks(t, WEEK), WEEK).where(
        F.col("metric_status") == V.MEASURED)
    return access.handoff_memo(supply, _nation_status(lens), measured)


# -- provenance -------------------------------------------------------------------------------

PROVENANCE = {
    "man": """
        SELECT doc_id, doc_id % 23 AS e, doc_id % 7 AS o, text, strlen(text) AS b,
               CASE doc_id % 23 WHEN 1 THEN 'Doc_' || doc_id WHEN 2 THEN 'doc-dup'
                    ELSE 'doc-' || doc_id END AS source_id,
               CASE WHEN doc_id % 23 = 10 THEN '../raw/x' || doc_id ELSE 'raw/doc' || doc_id END
                   AS local_path
        FROM documents""",
    "man_checked": """
        SELECT *, CASE e WHEN 0 THEN 'missing_fields' WHEN 1 THEN 'invalid_source_id'
            WHEN 2 THEN 'duplicate_source_id' WHEN 3 THEN 'invalid_source_type'
            WHEN 4 THEN 'invalid_official_url' WHEN 5 THEN 'invalid_baseline_sha256'
            WHEN 6 THEN 'invalid_baseline_bytes' WHEN 7 THEN 'invalid_max_download_bytes'
            WHEN 8 THEN 'baseline_exceeds_download_limit' WHEN 9 THEN 'invalid_baseline_acquired_at'
            WHEN 10 THEN 'local_path_traversal' WHEN 11 THEN 'baseline_file_missing'
            WHEN 12 THEN 'baseline_size_mismatch' WHEN 13 THEN 'baseline_sha256_mismatch' END
            AS reason
        FROM man""",
    "fresh": """
        SELECT source_id, local_path, status, error_category, fetched_bytes,
               CAST(CASE status WHEN 'unchanged' THEN 0 WHEN 'changed' THEN 1
                    WHEN 'invalid_baseline' THEN 3 ELSE 2 END AS INTEGER) AS exit_code
        FROM (SELECT source_id, local_path,
            CASE WHEN reason IS NOT NULL THEN 'invalid_baseline' WHEN o IN (0, 2) THEN 'unavailable'
                 WHEN o IN (3, 4) THEN 'oversize' WHEN o = 1 THEN 'changed' ELSE 'unchanged' END
                AS status,
            CASE WHEN reason IS NOT NULL THEN reason WHEN o = 0 THEN 'not_fetched'
                 WHEN o = 2 THEN 'timeout' WHEN o = 3 THEN 'content_length_exceeds_limit'
                 WHEN o = 4 THEN 'stream_exceeds_limit' END AS error_category,
            CASE WHEN reason IS NOT NULL OR o IN (0, 2) THEN NULL WHEN o = 3 THEN b * 9 + 99
                 WHEN o = 4 THEN b * 9 + 88 WHEN o = 1 THEN b + 1 ELSE b END AS fetched_bytes
            FROM man_checked)""",
    "lvl": """
        SELECT (SELECT count(*) FROM labels) <> (SELECT count(*) FROM documents)
               OR (SELECT max(quality) FROM labels) IS DISTINCT FROM 1 AS refused""",
    "repro": r"""
        SELECT path, e <> 3 AS recreated, e <> 5 AS expected, expected_bytes, actual_bytes,
               e NOT IN (1, 2, 3, 5) AS byte_match,
               e IN (0, 4, 6) OR e = 1 AS normalized_match
        FROM (SELECT 'out/' || doc_id AS path, e, CASE WHEN e <> 5 THEN b END AS expected_bytes,
                     CASE WHEN e = 3 THEN NULL WHEN e = 2 THEN b + 1
                          WHEN e = 1 THEN b + len(text) - len(replace(text, chr(10), ''))
                          ELSE b END AS actual_bytes
              FROM (SELECT doc_id, text, strlen(text) AS b,
                           CASE WHEN doc_id % 7 = 1 AND NOT contains(text, chr(10)) THEN 0
                                ELSE doc_id % 7 END AS e FROM documents))""",
}


def _psql(query):
    return with_lenses(query, PROVENANCE)


def _manifest(lens):
    """(manifest, fingerprints, observations) lens: every document is an accepted source."""
    k, e = F.col("doc_id"), F.col("doc_id") % 23
    text = k.cast("string")
    size = F.octet_length("text").cast("bigint")
    sha = F.sha2("text", 256)
    source_id = F.when(e == 1, F.concat(F.lit("Doc_"), text)).when(e == 2, "doc-dup").otherwise(
        F.concat(F.lit("doc-"), text))
    path = F.when(e == 10, F.concat(F.lit("../raw/x"), text)).otherwise(
        F.concat(F.lit("raw/doc"), text))
    limit = size * 2 + 10
    docs = lens.table("documents")
    manifest = docs.select(
        source_id.alias("source_id"), F.when(e == 3, "html").otherwise("gtfs_zip").alias("source_type"),
        F.when(e == 4, "http://open.test/x").when(
            e != 0, F.concat(F.lit("https://open.test/d/"), text)).alias("official_url"),
        path.alias("local_path"),
        F.when(e == 5, F.upper(sha)).when(e == 13, F.sha2(F.concat("text", F.lit("x")), 256))
        .otherwise(sha).alias("baseline_sha256"),
        F.when(e == 6, -1).when(e == 12, size + 1).otherwise(size).alias("baseline_bytes"),
        F.when(e == 9, "2024-13-01").otherwise("2024-01-15").alias("baseline_acquired_at"),
        F.when(e == 7, 0).when(e == 8, size - 1).otherwise(limit).alias("max_download_bytes"))
    prints = docs.where(e != 11).select(
        path.alias("local_path"), size.alias("actual_bytes"), sha.alias("actual_sha256"))
    o = k % 7
    null = F.lit(None)
    changed = F.sha2(F.concat("text", F.lit("!")), 256)
    latest = docs.where(o != 0).select(
        source_id.alias("source_id"), F.lit("2024-02-02").alias("checked_at"),
        F.when(o == 1, changed).when(o != 2, sha).alias("fetched_sha256"),
        F.when(o == 1, size + 1).when(o == 4, size * 9 + 88).when(o != 2, size)
        .alias("fetched_bytes"),
        F.when(o == 3, size * 9 + 99).alias("declared_bytes"),
        F.when(o == 2, "timeout").alias("error_category"))
    older = docs.where(o != 0).select(
        source_id.alias("source_id"), F.lit("2024-02-01").alias("checked_at"),
        changed.alias("fetched_sha256"), size.alias("fetched_bytes"),
        null.cast("bigint").alias("declared_bytes"), null.cast("string").alias("error_category"))
    return manifest, prints, latest.unionByName(older)


def _checked(lens):
    manifest, prints, observations = _manifest(lens)
    return provenance.manifest_checks(manifest, prints, ["open.test"]), observations


@R.add("manifest_violations", _psql(
    "SELECT source_id, local_path, reason FROM man_checked WHERE reason IS NOT NULL"))
def manifest_violations(spark, sf_dir):
    return provenance.manifest_violations(_checked(Lens(spark, sf_dir))[0])


@R.add("freshness_report", _psql("SELECT * FROM fresh"))
def freshness_report(spark, sf_dir):
    return provenance.freshness_report(*_checked(Lens(spark, sf_dir)))


def _header(lens):
    """What the labels declare: a source each, in a schema that names its version by the best label."""
    return lens.table("labels").agg(
        F.concat(F.lit("v"), F.max("quality").cast("string")).alias("schema_version"),
        F.count(F.lit(1)).alias("expected_source_count"))


@R.add("manifest_rejection", _psql("""
    SELECT 'labelled' AS manifest, CASE WHEN s.refused IS NULL THEN source_id ELSE '<manifest>' END AS source_id,
           CASE WHEN s.refused IS NULL THEN status ELSE 'invalid_baseline' END AS status,
           coalesce(s.refused, error_category) AS error_category
    FROM (SELECT CASE WHEN v <> 'v1' THEN 'invalid_manifest_schema' WHEN n = 0 OR n <> found THEN 'invalid_source_count' END AS refused
          FROM (SELECT 'v' || max(quality) AS v, count(*) AS n,
                       (SELECT count(*) FROM documents SEMI JOIN labels USING (doc_id)) AS found FROM labels)) s
    JOIN (SELECT * FROM fresh SEMI JOIN (SELECT 'raw/doc' || doc_id AS p FROM labels
          UNION ALL SELECT '../raw/x' || doc_id FROM labels) ON local_path = p) ON TRUE
    UNION ALL
    SELECT 'all', CASE WHEN NOT refused THEN source_id ELSE '<manifest>' END,
           CASE WHEN NOT refused THEN status ELSE 'invalid_baseline' END,
           CASE WHEN NOT refused THEN error_category ELSE 'invalid_source_count' END
    FROM lvl JOIN fresh ON TRUE
    QUALIFY NOT refused OR row_number() OVER () = 1"""))
def manifest_rejection(spark, sf_dir):
    """The labelled documents are the sources that the labels declare; all documents are more than that."""
    lens = Lens(spark, sf_dir)
    checked, observations = _checked(lens)
    docs, labels = lens.table("documents"), lens.table("labels").select("doc_id")
    known = docs.join(labels, "doc_id", "left_semi")
    paths = labels.select(F.explode(F.array(*[
        F.concat(F.lit(p), F.col("doc_id").cast("string")) for p in ("raw/doc", "../raw/x")])).alias("local_path"))
    out = None
    for name, rows, sources in (
            ("labelled", checked.join(paths, "local_path", "left_semi"), known), ("all", checked, docs)):
        level = provenance.manifest_level(_header(lens), sources, "v1")
        part = provenance.freshness_report(rows, observations, level).select(
            F.lit(name).alias("manifest"), "source_id", "status", "error_category")
        out = part if out is None else out.unionByName(part)
    return out


@R.add("freshness_summary", _psql("""
    SELECT s AS status, count(source_id) AS n, (SELECT max(exit_code) FROM fresh) AS worst_exit
    FROM (SELECT unnest(['unchanged', 'changed', 'unavailable', 'oversize', 'invalid_baseline']) AS s)
    LEFT JOIN fresh ON status = s GROUP BY s"""))
def freshness_summary(spark, sf_dir):
    return provenance.freshness_summary(freshness_report(spark, sf_dir))


def _repro(lens):
    """Every document is a rebuilt file; some come back with CRLF, changed, missing or extra."""
    e = F.col("doc_id") % 7
    docs = lens.table("documents").withColumn(
        "path", F.concat(F.lit("out/"), F.col("doc_id").cast("string")))
    actual = F.when(e == 1, F.replace("text", F.lit("\n"), F.lit("\r\n"))).when(
        e == 2, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return (docs.where(e != 5).select("path", "text"),
            docs.where(e != 3).select("path", actual.alias("text")))


@R.add("reproduction_diff", _psql("SELECT * FROM repro"))
def reproduction_diff(spark, sf_dir):
    return provenance.reproduction_diff(*_repro(Lens(spark, sf_dir)))


# -- scores -----------------------------------------------------------------------------------

_PAIRS = [(c, s) for c, subs in V.SCORE_SUBCRITERIA.items() for s in subs]
_PAIR_SQL = ", ".join(f"{{'c': '{c}', 's': '{s}'}}" for c, s in _PAIRS)


def _scores(lens):
    """Every customer is scored on every sub-criterion, from its balance and key."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("criterion_id"),
                 F.lit(s).alias("subcriterion_id")) for i, (c, s) in enumerate(_PAIRS)])
    k = F.col("c_custkey")
    x = lens.spread("customer", "c_custkey").select("c_custkey", "c_nationkey", F.explode(rows).alias("p"))
    i = F.col("p.i")
    return x.select(
        k.alias("subject_id"), "p.criterion_id", "p.subcriterion_id", i.alias("i"),
        (((k * (i + 3) + F.col("c_nationkey")) % 11) / 2).cast("decimal(4,2)").alias("score"))


_SCORES = {"scores": f"""
    SELECT c_custkey AS subject_id, p.c AS criterion_id, p.s AS subcriterion_id, i,
           (c_custkey * (i + 3) + c_nationkey) % 11 AS half
    FROM customer, (SELECT unnest([{_PAIR_SQL}]) AS p, unnest(range({len(_PAIRS)})) AS i)"""}


@R.add("scorecard", with_lenses("""
    SELECT subject_id, utility, completeness, challenge,
           round((utility + completeness + challenge) / 15 * 100 + 1e-9, 1) AS comparison_index
    FROM (SELECT subject_id,
                 max(s) FILTER (WHERE criterion_id = 'utility') AS utility,
                 max(s) FILTER (WHERE criterion_id = 'completeness') AS completeness,
                 max(s) FILTER (WHERE criterion_id = 'challenge') AS challenge
          FROM (SELECT subject_id, criterion_id,
                       CAST((2 * sum(half) + count(*)) // (2 * count(*)) AS DOUBLE) / 2 AS s
                FROM scores GROUP BY subject_id, criterion_id)
          GROUP BY subject_id)""", _SCORES))
def scorecard(spark, sf_dir):
    return score.scorecard(_scores(Lens(spark, sf_dir)))


@R.add("scorecard_contract", with_lenses("""
    SELECT subject_id, rule_id, n FROM (
        SELECT subject_id, 'out_of_range' AS rule_id, count(*) AS n FROM bad WHERE v = 1
        GROUP BY subject_id
        UNION ALL SELECT subject_id, 'not_half_step', count(*) FROM bad WHERE v = 2
        GROUP BY subject_id
        UNION ALL SELECT subject_id, 'missing_evidence', count(*) FROM bad WHERE v = 3
        GROUP BY subject_id
        UNION ALL SELECT subject_id, 'missing_subcriterion', count(*) FROM bad WHERE v = 4
        GROUP BY subject_id
        UNION ALL SELECT subject_id, 'duplicate_subcriterion', count(*) FROM bad WHERE v = 5
        GROUP BY subject_id
        UNION ALL SELECT subject_id, 'unknown_subcriterion', count(*) FROM bad WHERE v = 6
        GROUP BY subject_id
        UNION ALL SELECT subject_id, 'missing_subcriterion', count(*) FROM bad WHERE v = 6
        GROUP BY subject_id)""",
    {**_SCORES, "bad": "SELECT subject_id, (subject_id + 5 * i) % 37 AS v FROM scores"})
    .replace("SELECT subject_id, rule_id, n FROM (",
             "SELECT subject_id, rule_id, CAST(sum(n) AS BIGINT) AS n FROM (")
    + " GROUP BY subject_id, rule_id")
def scorecard_contract(spark, sf_dir):
    v = (F.col("subject_id") + 5 * F.col("i")) % 37
    s = _scores(Lens(spark, sf_dir)).withColumn("v", v)
    s = s.where("v <> 4").select(
        "subject_id", "criterion_id",
        F.when(F.col("v") == 6, "glamour").otherwise(F.col("subcriterion_id"))
        .alias("subcriterion_id"),
        F.when(F.col("v") == 1, 5.5).when(F.col("v") == 2, 2.25).otherwise(F.col("score"))
        .cast("decimal(4,2)").alias("score"),
        F.when(F.col("v") == 3, " ").otherwise("note").alias("evidence"),
        F.explode(F.when(F.col("v") == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        .alias("copy"))
    return score.scorecard_contract(s.drop("copy"))


@R.add("release_decision", _psql(f"""
    SELECT check_id, n_failed,
           CASE WHEN sum(n_failed) OVER () = 0 THEN 'GO' ELSE 'NO_GO' END AS decision
    FROM (SELECT 'accepted_sources' AS check_id,
                 (SELECT count(*) FROM man_checked WHERE reason IS NOT NULL) AS n_failed
          UNION ALL SELECT 'normalized_reconstruction',
                 (SELECT count(*) FROM repro WHERE expected AND NOT normalized_match)
          UNION ALL SELECT 'exact_byte_reconstruction',
                 (SELECT count(*) FROM repro WHERE expected AND NOT byte_match)
          UNION ALL SELECT 'no_unexpected_files',
                 (SELECT count(*) FROM repro WHERE NOT expected)
          UNION ALL SELECT 'sources_available',
                 (SELECT CASE WHEN refused THEN 1 ELSE (SELECT count(*) FROM fresh WHERE exit_code > 1) END FROM lvl)
          UNION ALL SELECT 'manifest_accepted', (SELECT CAST(refused AS BIGINT) FROM lvl)
          UNION ALL SELECT 'scorecard_accepted', (SELECT count(*) FROM ({R.sql["scorecard_contract"]})))"""))
def release_decision(spark, sf_dir):
    lens = Lens(spark, sf_dir)
    checked, observations = _checked(lens)
    level = provenance.manifest_level(_header(lens), lens.table("documents"), "v1")
    return provenance.release_decision(
        checked, provenance.reproduction_diff(*_repro(lens)),
        provenance.freshness_report(checked, observations, level),
        findings={"manifest_accepted": level,
                  "scorecard_accepted": scorecard_contract(spark, sf_dir)})


@R.add("top_improvements", """
    SELECT o_custkey AS subject_id, CAST(rn AS INTEGER) AS priority, o_orderkey AS improvement_id
    FROM (SELECT o_custkey, o_orderkey, row_number() OVER (
              PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    WHERE rn <= 3""")
def top_improvements(spark, sf_dir):
    items = Lens(spark, sf_dir).table("orders").select(
        F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("improvement_id"),
        F.col("o_totalprice").alias("expected_gain"))
    return score.top_improvements(items)


# -- contracts --------------------------------------------------------------------------------


@R.add("metric_contract", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
           CASE l_partkey % 50 WHEN 1 THEN 'unknown_status' WHEN 2 THEN 'measured_without_value'
                WHEN 3 THEN 'measured_with_reason' WHEN 4 THEN 'value_without_measurement'
                WHEN 5 THEN 'reason_missing' WHEN 6 THEN 'measured_without_value' END AS violation
    FROM lineitem WHERE l_partkey % 50 BETWEEN 1 AND 6""")
def metric_contract(spark, sf_dir):
    e = F.col("l_partkey") % 50
    q = F.col("l_quantity").cast("bigint")
    status = F.when(e == 1, "estimated").when(e.isin(4, 5, 7), V.INVALID_INPUT).when(
        e == 8, V.NOT_CONFIRMED).otherwise(V.MEASURED)
    m = Lens(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", status.alias("metric_status"),
        F.when(e == 6, -q).when(~e.isin(2, 5, 7, 8), q).alias("value"),
        F.when(e.isin(3, 4, 7), "why").when(e == 5, "　").alias("reason"))
    return contracts.metric_contract(m).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "violation")


@R.add("week_contract", """
    SELECT c_name AS feed_id, CAST(CASE WHEN c_custkey % 6 = 1 THEN 6 ELSE 7 END AS BIGINT) AS n_dates,
           CASE c_custkey % 6 WHEN 1 THEN 'not_seven_dates' WHEN 2 THEN 'not_consecutive'
                WHEN 3 THEN 'bounds_mismatch' WHEN 4 THEN 'not_consecutive' END AS violation
    FROM customer""")
def week_contract(spark, sf_dir):
    c = Lens(spark, sf_dir).spread("customer", "c_name")
    e = F.col("c_custkey") % 6
    base = F.date_add(F.lit(date(2026, 1, 5)), ((F.col("c_custkey") % 50) * 7).cast("int"))
    i = F.col("i")
    shift = F.when((e == 2) & (i == 6), 7).when((e == 4) & (i == 3), 2).when(
        e == 3, i + 1).otherwise(i)
    days = (
        c.select("c_name", "c_custkey", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i"))
        .where((e != 1) | (i != 2))
        .select(F.col("c_name").alias("feed_id"), F.date_add(base, shift).alias("service_date")))
    weeks = c.select(F.col("c_name").alias("feed_id"), base.alias("week_start"),
                     F.date_add(base, 6).alias("week_end"))
    return contracts.week_contract(days, weeks)


_KEYS = list(V.STRUCTURE_METRICS)


def _records(lens):
    """Metric records, four customers to a comparison set; some break one rule each."""
    k, e = F.col("c_custkey"), F.col("c_custkey") % 31
    text = F.lit("noted")
    sha = F.sha2(F.col("c_name"), 256)
    keys = F.array(*map(F.lit, _KEYS))
    day = F.date_add(F.lit(date(2026, 4, 6)), F.when(e == 3, 7).otherwise(0))
    dates = F.transform(F.sequence(F.lit(0), F.lit(6)),
                        lambda i: F.date_add(day, i).cast("string"))
    limits = F.array(*map(F.lit, ("a", "b", "c", "d")))
    return lens.table("customer").select(
        F.call_function("div", k, F.lit(4)).alias("set_id"), F.col("c_name").alias("feed_id"),
        F.when(e == 1, "v0").otherwise("v1").alias("metric_version"),
        day.alias("week_start"), F.date_add(day, 6).alias("week_end"),
        F.when(e == 4, F.slice(dates, 1, 6)).otherwise(dates).alias("date_keys"),
        F.when(e == 5, F.reverse(keys)).otherwise(keys).alias("metric_keys"),
        text.alias("municipality"), text.alias("municipality_code"), text.alias("source_zip_path"),
        F.when(e == 6, F.upper(sha)).otherwise(sha).alias("source_zip_sha256"),
        F.when(e == 7, " ").otherwise("noted").alias("scope_note"),
        text.alias("official_reference_date"), text.alias("checked_at"),
        text.alias("metric_computed_at"),
        F.when(e == 8, 0).otherwise(10).alias("source_zip_size_bytes"),
        F.when(e == 9, "part").otherwise("whole_feed").alias("measurement_scope"),
        F.when(e == 10, "comparable").otherwise("independent_not_comparable")
        .alias("comparison_mode"),
        F.when(e == 11, F.slice(limits, 1, 3)).when(
            e == 12, F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit(""))).otherwise(limits)
        .alias("limitations"))


@R.add("comparable_set", """
    WITH r AS (SELECT c_custkey // 4 AS set_id, c_custkey % 31 AS e FROM customer),
    g AS (SELECT set_id, count(*) AS m, count(*) FILTER (WHERE e = 1) AS v,
                 count(*) FILTER (WHERE e = 3) AS w, count(*) FILTER (WHERE e = 4) AS d,
                 count(*) FILTER (WHERE e = 5) AS k, count(*) FILTER (WHERE e = 6) AS s,
                 count(*) FILTER (WHERE e = 7) AS t FROM r GROUP BY set_id)
    SELECT set_id, rule_id, n FROM (
        SELECT set_id, 'metric_version' AS rule_id, v AS n FROM g
        UNION ALL SELECT set_id, 'week_mismatch', CAST(w > 0 AND w < m AS BIGINT) FROM g
        UNION ALL SELECT set_id, 'date_keys_mismatch',
                  CAST((w > 0 AND w < m) OR (d > 0 AND d < m) AS BIGINT) FROM g
        UNION ALL SELECT set_id, 'missing_text', t FROM g
        UNION ALL SELECT set_id, 'bad_sha256', s FROM g
        UNION ALL SELECT set_id, 'metric_keys', k FROM g) WHERE n > 0""")
def comparable_set(spark, sf_dir):
    return contracts.comparable_set(_records(Lens(spark, sf_dir)), "v1")


@R.add("independent_contract", """
    SELECT c_name AS feed_id, CASE c_custkey % 31 WHEN 1 THEN 'metric_version'
        WHEN 5 THEN 'metric_keys' WHEN 6 THEN 'bad_sha256' WHEN 7 THEN 'missing_text'
        WHEN 8 THEN 'source_size' WHEN 9 THEN 'measurement_scope' WHEN 10 THEN 'comparison_mode'
        WHEN 11 THEN 'too_few_limitations' ELSE 'blank_limitation' END AS rule_id
    FROM customer WHERE c_custkey % 31 IN (1, 5, 6, 7, 8, 9, 10, 11, 12)""")
def independent_contract(spark, sf_dir):
    return contracts.independent_contract(_records(Lens(spark, sf_dir)), "v1")


# -- weekly freshness -------------------------------------------------------------------------

_STATUS_OF = {"click": "unchanged", "view": "changed", "error": "unavailable",
              "signup": "oversize", "purchase": "invalid_baseline"}
_STATUS_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS_OF.items()) + " END"
_WEEKLY = f"""
    SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, {_STATUS_SQL} AS status,
           count(*) AS n
    FROM events"""


def _observed(events):
    status = F.lit(None).cast("string")
    for k, v in _STATUS_OF.items():
        status = F.when(F.col("event_type") == k, v).otherwise(status)
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_id"),
        F.col("ts").cast("timestamp").alias("checked_at"), status.alias("status"))


@R.add("freshness_weekly", _WEEKLY + " GROUP BY 1, 2")
def freshness_weekly(spark, sf_dir):
    return freshness.weekly_counts(_observed(Lens(spark, sf_dir).table("events")))


@R.add("freshness_stream", _WEEKLY + " GROUP BY 1, 2")
def freshness_stream(spark, sf_dir):
    """Runs the stream to the end of the arrived files and returns all weeks so far."""
    lens = Lens(spark, sf_dir)
    schema = lens.table("events").schema
    source = spark.readStream.schema(schema).parquet(f"{lens.dir}/events*.parquet")
    folder = shared_folder(spark, "freshness")
    freshness.run_available(spark, _observed(source), f"{folder}/out", f"{folder}/state")
    return freshness.current(spark, f"{folder}/out")
