"""The operators of this package as registered queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import (
    conversation_repair, decontaminate, jaccard_forest, line_crf, merkle, odd_sketch, packing, pu_quality, redirects, suffix_dedup, token_ids, warc, weak_toxicity,
)
from llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        run.__name__ = function.__name__
        QUERIES[function.__name__] = run
        if sql:
            ORACLE[function.__name__] = sql.strip()
        return function

    return register


@query()
def op1_token_files(spark, sf_dir):
    return token_ids.round_trip(table(spark, sf_dir, "documents"))


@query()
def op2_bin_slack_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


@query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, upper(sha1(html)) AS h, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
)
def op3_warc_round_trip(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


@query()
def op4_line_crf_filter(spark, sf_dir):
    found = line_crf.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("boilerplate_lines")


@query()
def op5_pu_quality(spark, sf_dir):
    return pu_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_weak_toxicity(spark, sf_dir):
    return weak_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_suffix_dedup(spark, sf_dir):
    """Besides the digest columns the text that is left, where a byte of a character that a cut splits is shown as U+FFFD,
    and the bytes in repeated passages: strings of 400 bytes or of over 50 words that start elsewhere too."""
    found = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.selectExpr(
        "doc_id", "n_bytes", "n_removed", "cast(size(spans) as long) AS n_spans", "kept_sha256", "make_valid_utf8(cast(kept as string)) AS text",
        "aggregate(passages, 0L, (n, s) -> n + s.stop - s.first) AS n_passage_bytes",
    )


@query()
def op8_jaccard_forest(spark, sf_dir):
    return jaccard_forest.join(table(spark, sf_dir, "documents"))


URL_RULES = redirects.rules(
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@query(
    r"""
WITH RECURSIVE rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
found AS (
  SELECT url AS a, unnest([
    regexp_extract(html, '(?is)<link\s[^>]*rel\s*=\s*["'']?canonical[^>]*href\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(html, '(?is)<link\s[^>]*href\s*=\s*["'']?([^"''\s>]+)["'']?[^>]*rel\s*=\s*["'']?canonical', 1),
    regexp_extract(html, '(?is)<meta\s[^>]*refresh[^>]*url\s*=\s*''?([^"''\s>]+)', 1)]) AS b
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
edges AS (SELECT a, b FROM found WHERE contains(b, '://') UNION SELECT b, a FROM found WHERE contains(b, '://')),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
split AS (
  SELECT DISTINCT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT coalesce(url, '') AS url FROM pages UNION SELECT b FROM edges)),
ruled AS (
  SELECT url, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS own
  FROM split LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY url),
bad AS (SELECT DISTINCT reach.a AS url FROM reach JOIN ruled ON ruled.url = reach.b WHERE own = 'block')
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN bad.url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM pages JOIN ruled ON ruled.url = coalesce(pages.url, '') LEFT JOIN bad ON bad.url = ruled.url
"""
)
def op9_redirect_rules(spark, sf_dir):
    return redirects.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query(
    r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM iw WHERE len(w) > 0)),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM dw, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT DISTINCT doc_id, item_id, i, size FROM places JOIN windows USING (size, words)),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS k FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
)
def op10_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digests(found)


@query(
    r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM dw WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, least(doc_id, coalesce(b, doc_id)) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON a = doc_id
"""
)
def op11_odd_sketch_dedup(spark, sf_dir):
    return odd_sketch.classes(table(spark, sf_dir, "documents"))


def _sql_crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text in SQL, bit by bit."""
    step = "list_reduce(list_concat([xor(a, b)], [k::BIGINT for k in range(8)]), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(x)::BIGINT for x in string_split({text}, '')]), lambda a, b: {step}), 4294967295)"


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_ROW = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text"))


@query(
    f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('x' || lang, '') AS tree, sha256({_ROW.format(n_chars="n_chars")}) AS leaf,
    CASE WHEN {_sql_crc32("doc_id::VARCHAR")} % 7 = 0 THEN sha256({_ROW.format(n_chars="(n_chars + 1)")}) END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS cnt FROM hashed),
up AS (
  SELECT 0 AS lv, tree, idx, cnt, leaf AS d FROM leaves
  UNION ALL
  SELECT lv + 1, tree, idx // 2, (cnt + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM up WHERE cnt > 1 GROUP BY lv, tree, idx // 2, cnt),
tops AS (SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS cnt FROM up WHERE cnt = 1),
over_up AS (
  SELECT 0 AS lv, idx, cnt, subroot AS d FROM tops
  UNION ALL
  SELECT lv + 1, idx // 2, (cnt + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM over_up WHERE cnt > 1 GROUP BY lv, idx // 2, cnt),
whole AS (
  SELECT 0 AS part, tree, lv, idx, cnt, d FROM up UNION ALL SELECT 1, '', lv, idx, cnt, d FROM over_up),
steps AS (
  SELECT x.part, x.tree, x.lv, x.idx, x.cnt, y.d AS sibling, y.idx < x.idx AS on_left
  FROM whole x LEFT JOIN whole y ON (x.part, x.tree, x.lv, xor(x.idx, 1)) = (y.part, y.tree, y.lv, y.idx)),
walk AS (
  SELECT doc_id, leaf, tree, 0 AS part, 0 AS lv, tree AS at, idx, coalesce(tampered, leaf) AS f, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, CASE WHEN s.cnt = 1 THEN 1 ELSE w.part END, CASE WHEN s.cnt = 1 THEN 0 ELSE w.lv + 1 END, CASE WHEN s.cnt = 1 THEN '' ELSE w.at END,
    CASE WHEN s.cnt = 1 THEN t.idx ELSE w.idx // 2 END,
    CASE WHEN s.cnt = 1 THEN f WHEN s.sibling IS NULL THEN sha256(f) WHEN s.on_left THEN sha256(s.sibling || f) ELSE sha256(f || s.sibling) END,
    proof || CASE WHEN s.cnt > 1 THEN coalesce(s.sibling, '') ELSE '' END
  FROM walk w JOIN steps s ON (s.part, s.tree, s.lv, s.idx) = (w.part, w.at, w.lv, w.idx) JOIN tops t ON t.tree = w.tree WHERE s.cnt > 1 OR w.part = 0)
SELECT w.doc_id, w.leaf, t.subroot, r.d AS root, sha256(w.proof) AS proof_sha256, w.f AS folded_root, w.f = r.d AS verified
FROM walk w JOIN tops t ON t.tree = w.tree JOIN over_up r ON r.cnt = 1 AND w.part = 1 AND w.lv = r.lv
"""
)
def op12_merkle_manifest(spark, sf_dir):
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def _sql_after_inserts(state: str, roles: tuple[str, ...]) -> str:
    """A state's value after inserts of the given roles; null where the state can't be."""
    lines = ", ".join(f"'{role}:'" for role in roles)
    value = f"{{'cost': {state}.cost + {2 * len(roles)}, 'audit': {state}.audit || '{'I' * len(roles)}', 'lines': list_concat({state}.lines, [{lines}])}}"
    return f"CASE WHEN {state} IS NOT NULL THEN {value} END" if roles else state


def _sql_edit(state: str, cost: str, letter: str, line: str = "", allowed: str = "true") -> str:
    """A state's value after one edit of the row; null where the edit isn't allowed."""
    lines = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
    value = f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'lines': {lines}}}"
    return f"CASE WHEN {state} IS NOT NULL AND {allowed} THEN {value} END"


def _sql_repair() -> str:
    """One row's edits as SQL: the least ``(cost, audit, lines)`` of each of the states q0 (nothing yet), qs, qu and qa."""
    inserts = {
        "q0": [("p.q0", ())],
        "qs": [("p.qs", ())],
        "qu": [("p.qu", ()), *((f"p.{q}", ("user",)) for q in ("q0", "qs", "qa"))],
        "qa": [("p.qa", ()), ("p.qu", ("assistant",)), *((f"p.{q}", ("user", "assistant")) for q in ("q0", "qs"))],
    }
    edits = {state: [_sql_edit(state, "3", "D")] for state in inserts}
    ways = {"qs": [("q0", "s")], "qu": [(q, "u") for q in ("q0", "qs", "qa")], "qa": [("qu", "a")]}
    for state, before in ways.items():
        for start, initial in before:
            edits[state].append(_sql_edit(start, "extra", "K", "role || ':' || text", f"NOT must AND initial = '{initial}'"))
            if initial != "s":
                role = "user" if initial == "u" else "assistant"
                edits[state].append(_sql_edit(start, "2 + extra", "R", f"'{role}:' || text", "NOT must"))
    known = ", ".join(f"least({', '.join(_sql_after_inserts(*way) for way in ways)}) AS {state}" for state, ways in inserts.items())
    values = ", ".join(f"least({', '.join(each)}) AS {state}" for state, each in edits.items())
    return f"SELECT conv_id, k, {values} FROM (SELECT d.*, {known} FROM walk p JOIN faults d ON d.conv_id = p.conv_id AND d.k = p.k + 1)"


_VALUE = "STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])"


@query(
    rf"""
WITH RECURSIVE hit AS (
  SELECT *, {_sql_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role, h,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text FROM hit),
marked AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, sha256(strlen(role) || ':' || role || text) AS mark
  FROM damaged, (SELECT unnest(generate_series(1, 2)) AS copy) WHERE h <> 0 AND (copy = 1 OR h = 3)),
placed AS (
  SELECT *, row_number() OVER conv AS k, row_number() OVER (PARTITION BY conv_id, mark ORDER BY turn NULLS FIRST) AS seen,
    CASE WHEN lag(initial) OVER conv || initial NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS illegal
  FROM marked WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark)),
faults AS (
  SELECT conv_id, turn, k, role, text, initial, illegal, fault, coalesce(fault IN ('blank', 'duplicate'), false) AS must, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS extra
  FROM (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault FROM placed)),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'cost': 0, 'audit': '', 'lines': []}}::{_VALUE} AS q0, NULL::{_VALUE} AS qs, NULL::{_VALUE} AS qu, NULL::{_VALUE} AS qa FROM conversations
  UNION ALL
  {_sql_repair()}),
repaired AS (
  SELECT conv_id, arg_max(least(q0, {_sql_after_inserts("qs", ("user", "assistant"))}, {_sql_after_inserts("qu", ("assistant",))}, qa), k) AS best
  FROM walk GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, sum(illegal) AS illegal
  FROM faults GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM repaired LEFT JOIN counted USING (conv_id)
"""
)
def op13_conversation_repair(spark, sf_dir):
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))
