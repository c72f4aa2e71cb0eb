"""Independent SQL for the queries of the catalogue, in the dialect of DuckDB."""

from __future__ import annotations

from tallyworks.functions.text import LISTED_WORDS, STOPWORDS
from tallyworks.plans.catalog import BINS, MIN_BALANCE, PLACES, PRIORITIES, SUPPORT_PER_MILLE


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _clean(text: str) -> str:
    """Entities that stand for no letter become blanks, quotes vanish."""
    named = "&(amp|lt|gt|quot|nbsp|copy|middot);"
    return f"replace(replace(regexp_replace(lower({text}), '{named}', ' ', 'g'), '&#39;', ''), '''', '')"


def _words(source: str, text: str, keep: str = "") -> str:
    split = f"SELECT {keep} unnest(string_split_regex({_clean(text)}, '[^a-zA-Z]+')) AS word FROM {source}"
    return f"(SELECT * FROM ({split}) WHERE word <> '')"


def _word_count(source: str, text: str) -> str:
    return f"SELECT word, count(*) AS n FROM {_words(source, text)} GROUP BY word"


def _escaped(text: str) -> str:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = f"replace({text}, '{sign}', '{entity}')"
    return f"replace(replace({text}, chr(10), '&#10;'), chr(13), '&#13;')"


_STOP = (
    "SELECT DISTINCT unnest(string_split_regex(replace(lower(text), '''', ''), '[ \\t\\n\\r\\f]+')) AS word FROM benchmark"
)
_EVENT_TEXT = "event_type || ' ' || props"
_WITHOUT_STOP = "SELECT * FROM ({counts}) WHERE word NOT IN (SELECT word FROM ({stop}))"
_MELTED = (
    "(SELECT 'quantity' AS position, CAST(l_quantity AS INTEGER) AS number FROM lineitem "
    "UNION ALL SELECT 'line', l_linenumber FROM lineitem)"
)
_GAPS = (
    "SELECT CAST(l_quantity AS INTEGER) AS quantity, l_orderkey, l_orderkey - lag(l_orderkey, 1, 0) "
    "OVER (PARTITION BY l_quantity ORDER BY l_orderkey) AS gap FROM lineitem"
)
_PLACE = f"""
    SELECT c_custkey,
           CASE WHEN c_acctbal < 0 THEN 'NullOrEmpty'
                WHEN n_name IN ({_quoted(PLACES)}) THEN n_name ELSE 'Unknown' END AS state
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_LABELS = "(SELECT doc_id, quality, toxic FROM labels)"
_TURNS = "(SELECT conv_id, turn, role FROM conversations)"
_ON = f"{_LABELS} l {{how}} JOIN {_TURNS} t ON l.doc_id = t.conv_id"
_CODE = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORITIES.items()) + " END"
_BLOOM_NEST = f"""
    SELECT c_custkey, c_acctbal, 0 AS part, count(*) AS n_children,
           string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) AS child_ids
    FROM customer JOIN events ON c_custkey = user_id WHERE c_acctbal >= {MIN_BALANCE}
    GROUP BY c_custkey, c_acctbal"""
_MEMBERS = (
    "(SELECT DISTINCT member FROM (SELECT unnest(string_split_regex(text, '[^a-zA-Z]+')) AS member FROM benchmark) "
    "WHERE member <> '')"
)
_RAW_TOKENS = (
    "(SELECT doc_id, regexp_replace(replace(t, '''', ''), '[^a-zA-Z]', ' ', 'g') AS token FROM "
    "(SELECT doc_id, unnest(string_split_regex(text, '[ \\t\\n\\r\\f]+')) AS t FROM documents))"
)
_BINNED = (
    "("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS bin, doc_id FROM documents WHERE '{tag}' IN (lang, source)" for tag, name in BINS.items()
    )
    + " UNION ALL SELECT 'license-post', doc_id FROM documents WHERE contains(lower(text), 'license'))"
)
_HTML = "lower(html)"
for _entity, _sign in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, '{_entity}', '{_sign}')"


def _term_weights(document: str) -> str:
    return f"""
        WITH t AS (SELECT word, count(*) AS tf, count(DISTINCT doc) AS df
                   FROM {_words('documents', 'text', f'{document} AS doc,')} GROUP BY word)
        SELECT word, tf, df,
               round(tf * ln((SELECT count(DISTINCT {document}) FROM documents) / df), 6) AS weight FROM t"""


_PAIRS = "SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey"
_BASIS = f"""
    pairs AS ({_PAIRS}),
    bound AS (SELECT greatest(1, CAST(ceil(count(DISTINCT l_orderkey) * {SUPPORT_PER_MILLE} / 1000.0) AS BIGINT)) AS least
              FROM pairs)"""


def _itemsets(bound: str, condition: str) -> str:
    return f"""
        WITH RECURSIVE {_BASIS},
        frequent AS (SELECT p_brand FROM pairs GROUP BY p_brand HAVING count(*) >= (SELECT {bound} FROM bound)),
        kept AS (SELECT * FROM pairs WHERE p_brand IN (SELECT p_brand FROM frequent)),
        sets AS (
            SELECT l_orderkey, p_brand AS tail, p_brand AS itemset, 1 AS level FROM kept
            UNION ALL
            SELECT s.l_orderkey, k.p_brand, s.itemset || '/' || k.p_brand, s.level + 1
            FROM sets s JOIN kept k ON s.l_orderkey = k.l_orderkey AND k.p_brand > s.tail)
        SELECT itemset, count(*) AS support, level FROM sets WHERE {condition}
        GROUP BY itemset, level HAVING count(*) >= (SELECT {bound} FROM bound)"""


_CHILD_XML = f"'<comments turn=\"' || turn || '\" text=\"' || {_escaped('text')} || '\"/>'"

ORACLES: dict[str, str] = {
    "word_count": _word_count("documents", "text"),
    "word_count_lines": _word_count("conversations", "text"),
    "word_count_pages": _word_count("pages", "html"),
    "word_count_top10": _word_count("documents", "text") + " ORDER BY n DESC, word LIMIT 10",
    "word_count_stopwords": f"""
        SELECT word, n, word IN ({_quoted(STOPWORDS)}) AS is_stopword FROM ({_word_count('documents', 'text')})""",
    "listed_word_count": f"SELECT * FROM ({_word_count('documents', 'text')}) WHERE word IN ({_quoted(LISTED_WORDS)})",
    "counter_report": f"""
        SELECT 'words' AS counter_group, word AS counter, n FROM ({_word_count('documents', 'text')})
        WHERE word IN ({_quoted(STOPWORDS)})""",
    "word_count_without_stopwords": _WITHOUT_STOP.format(counts=_word_count("documents", "text"), stop=_STOP),
    "min_max_count": 'SELECT user_id, min(ts) AS "first", max(ts) AS "last", count(*) AS n FROM events GROUP BY user_id',
    "min_max_and_words": f"""
        SELECT 'minmax' AS result, user_id, min(ts) AS "first", max(ts) AS "last", count(*) AS n, NULL AS word
        FROM events GROUP BY user_id
        UNION ALL
        SELECT 'words', NULL, NULL, NULL, n, word
        FROM ({_WITHOUT_STOP.format(counts=_word_count('events', _EVENT_TEXT), stop=_STOP)})""",
    "avg_by_hour": """
        SELECT hour(ts) AS hour, count(*) AS n, round(avg(length(props)), 6) AS average FROM events GROUP BY 1""",
    "median_std_by_hour": """
        SELECT hour(ts) AS hour, count(*) AS n, median(length(props)) AS median,
               round(stddev_samp(length(props)), 6) AS stddev FROM events GROUP BY 1""",
    "median_std_value_by_hour": """
        SELECT hour(ts) AS hour, count(*) AS n, round(median(value), 6) AS median,
               round(stddev_samp(value), 6) AS stddev FROM events GROUP BY 1""",
    "multi_avg_by_group": f"""
        SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 6) AS avg_o_totalprice,
               round(avg(o_custkey), 6) AS avg_customer_number, round(avg({_CODE}), 6) AS avg_o_orderpriority
        FROM orders GROUP BY o_orderstatus""",
    "distinct_users": 'SELECT DISTINCT CAST(user_id AS VARCHAR) AS "user" FROM events WHERE user_id IS NOT NULL',
    "distinct_users_sorted": "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL ORDER BY user_id",
    "unique_user_count": "SELECT count(DISTINCT user_id) AS n FROM events",
    "value_frequency": f"SELECT number, count(*) AS n FROM {_MELTED} GROUP BY number",
    "position_frequency": f"SELECT position, number, count(*) AS n FROM {_MELTED} GROUP BY position, number",
    "relative_frequency": f"""
        SELECT number, count(*) AS n, round(count(*) / (SELECT count(*) FROM {_MELTED}), 6) AS share
        FROM {_MELTED} GROUP BY number""",
    "top10_frequency": f"""
        SELECT number, count(*) AS n FROM {_MELTED} GROUP BY number ORDER BY n DESC, number LIMIT 10""",
    "gap_rows": _GAPS,
    "gap_stats": f"""
        SELECT quantity, count(*) AS n, round(avg(gap), 6) AS average, round(stddev_samp(gap), 6) AS stddev,
               max(l_orderkey) AS "last", median(gap) AS median FROM ({_GAPS}) GROUP BY quantity""",
    "gap_stats_users": """
        WITH e AS (SELECT user_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS micros FROM events),
        g AS (SELECT user_id, micros, micros - lag(micros, 1, 0) OVER (PARTITION BY user_id ORDER BY micros) AS gap FROM e)
        SELECT user_id, count(*) AS n, max(micros) AS "last", median(gap) AS median,
               round(avg(gap) / 1e6, 3) AS average, round(stddev_samp(gap) / 1e6, 3) AS stddev FROM g GROUP BY user_id""",
    "category_count": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment",
    "class_count": f"SELECT state, count(*) AS n FROM ({_PLACE}) GROUP BY state",
    "word_count_by_state": f"""
        SELECT state, word, count(*) AS n FROM {_words('events', _EVENT_TEXT, 'user_id,')} w
        JOIN ({_PLACE}) p ON w.user_id = p.c_custkey GROUP BY state, word""",
    "join_inner": f"SELECT * FROM {_ON.format(how='INNER')}",
    "join_left": f"SELECT * FROM {_ON.format(how='LEFT')}",
    "join_right": f"SELECT * FROM {_ON.format(how='RIGHT')}",
    "join_full": f"SELECT * FROM {_ON.format(how='FULL')}",
    "join_anti": f"SELECT * FROM {_ON.format(how='FULL')} WHERE doc_id IS NULL OR conv_id IS NULL",
    "broadcast_inner": f"SELECT * FROM {_ON.format(how='INNER')}",
    "broadcast_left": f"SELECT * FROM {_ON.format(how='RIGHT')}",
    "nest_children": """
        SELECT o_orderkey, o_orderstatus, 0 AS part, count(l_partkey) AS n_children,
               coalesce(string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_partkey, l_linenumber), '') AS child_ids
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""",
    "nest_children_parts": """
        WITH placed AS (
            SELECT o_orderkey, l_partkey, l_linenumber,
                   (row_number() OVER (PARTITION BY o_orderkey ORDER BY l_partkey, l_linenumber) - 1) // 3 AS part
            FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)
        SELECT o_orderkey, CAST(part AS INTEGER) AS part, count(l_partkey) AS n_children,
               coalesce(string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_partkey, l_linenumber), '') AS child_ids
        FROM placed GROUP BY o_orderkey, part""",
    "nest_self": """
        SELECT p.conv_id, p.role, p.text, 0 AS part, count(c.turn) AS n_children,
               coalesce(string_agg(CAST(c.turn AS VARCHAR), ' ' ORDER BY c.turn), '') AS child_ids
        FROM conversations p LEFT JOIN conversations c ON p.conv_id = c.conv_id AND c.turn <> 0
        WHERE p.turn = 0 GROUP BY p.conv_id, p.role, p.text""",
    "nested_xml": f"""
        WITH c AS (SELECT conv_id, string_agg({_CHILD_XML}, '' ORDER BY turn) AS inside
                   FROM conversations WHERE turn <> 0 GROUP BY conv_id)
        SELECT p.conv_id, 0 AS part, '<post conv_id="' || p.conv_id || '" text="' || {_escaped('p.text')} || '"' ||
               CASE WHEN inside IS NULL THEN '/>' ELSE '>' || inside || '</post>' END AS xml
        FROM conversations p LEFT JOIN c ON p.conv_id = c.conv_id WHERE p.turn = 0""",
    "bloom_join": _BLOOM_NEST,
    "bloom_join_both": _BLOOM_NEST,
    "grep": r"SELECT doc_id, text FROM documents WHERE regexp_full_match(text, '(?s).*\. The [a-z]+ .*\n.*')",
    "contains": "SELECT doc_id, text FROM documents WHERE contains(lower(text), 'license')",
    "threshold": "SELECT * FROM customer WHERE c_acctbal >= 1500.0",
    "not_category": "SELECT * FROM events WHERE event_type IS DISTINCT FROM 'error'",
    "bloom_build_probe_exact": f"SELECT * FROM {_TURNS} WHERE conv_id IN (SELECT doc_id FROM {_LABELS})",
    "bloom_token_filter": f"""
        SELECT doc_id, length(text) AS chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM {_RAW_TOKENS} WHERE token IN (SELECT member FROM {_MEMBERS}))""",
    "top10_records": "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
    "top10_distinct_values": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey DESC) AS place FROM part)
        WHERE place = 1 ORDER BY p_size DESC LIMIT 10""",
    "anonymize": "SELECT CAST(ts AS DATE) AS ts, event_type, value, props FROM events",
    "anonymize_rows": f"""
        SELECT '<row ts="' || strftime(ts, '%Y-%m-%d') || '" event_type="' || {_escaped('event_type')} ||
               '" props="' || {_escaped('props')} || '" >' AS line FROM events""",
    "anonymize_and_distinct": """
        SELECT 'anonymize' AS result, CAST(ts AS DATE) AS ts, event_type, value, props, NULL AS user_id FROM events
        UNION ALL
        SELECT DISTINCT 'distinct', NULL, NULL, NULL, NULL, user_id FROM events WHERE user_id IS NOT NULL""",
    "anonymize_text": """
        SELECT CASE WHEN event_type = 'error' THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d') END AS ts, event_type, value, props
        FROM events""",
    "min_max_count_text": """
        SELECT user_id, min(date_trunc('millisecond', ts)) AS "first", max(date_trunc('millisecond', ts)) AS "last", count(*) AS n
        FROM events WHERE event_type IS DISTINCT FROM 'error' GROUP BY user_id""",
    "gzip_words": f"SELECT member FROM {_MEMBERS}",
    "bloom_key_filter": f"""
        SELECT count(*) AS n_members, true AS none_lost, true AS few_others FROM {_TURNS}
        WHERE conv_id IN (SELECT doc_id FROM {_LABELS})""",
    "bloom_key_filter_exact": f"""
        SELECT count(*) AS n_members, true AS none_lost, true AS few_others FROM {_TURNS}
        WHERE conv_id IN (SELECT doc_id FROM {_LABELS})""",
    "bloom_token_flags": f"""
        SELECT count(*) AS n_documents, true AS none_lost, true AS few_others FROM documents
        WHERE doc_id IN (SELECT doc_id FROM {_RAW_TOKENS} WHERE token IN (SELECT member FROM {_MEMBERS}))""",
    "sample_repeatable": "SELECT count(*) AS n, true AS likely, true AS subset, true AS same FROM lineitem",
    "category_count_csv": """
        SELECT CASE WHEN c_acctbal < 0 THEN '' WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, count(*) AS n
        FROM customer GROUP BY 1""",
    "nested_xml_parts": f"""
        WITH c AS (SELECT *, 24 + strlen(text) AS cost FROM conversations WHERE turn <> 0),
        placed AS (SELECT *, (sum(cost) OVER (PARTITION BY conv_id ORDER BY turn, text) - cost) // 1024 AS part FROM c),
        inner_parts AS (SELECT conv_id, part, string_agg({_CHILD_XML}, '' ORDER BY turn, text) AS inside FROM placed GROUP BY conv_id, part)
        SELECT p.conv_id, CAST(coalesce(part, 0) AS INTEGER) AS part, '<post conv_id="' || p.conv_id || '" text="' || {_escaped('p.text')} || '"' ||
               CASE WHEN inside IS NULL THEN '/>' ELSE '>' || inside || '</post>' END AS xml
        FROM conversations p LEFT JOIN inner_parts c ON p.conv_id = c.conv_id WHERE p.turn = 0""",
    "corpus_file_weights": _term_weights("concat_ws('-', lang, source)"),
    "synthetic_words_joined": "SELECT count(*) AS n, true AS all_known, 0 AS n_differ FROM events",
    "shuffle_rows_mixed": "SELECT count(*) AS n, true AS mixed, true AS even FROM events",
    "shuffle_rows": "SELECT * FROM events",
    "bins_by_tag": f"SELECT bin, doc_id FROM {_BINNED}",
    "bin_counts": f"SELECT bin, count(*) AS n FROM {_BINNED} GROUP BY bin",
    "bins_by_year": "SELECT o_orderkey, o_orderdate, year(o_orderdate) AS year FROM orders WHERE o_orderdate IS NOT NULL",
    "inverted_index": f"""
        SELECT url, 0 AS part, string_agg(CAST(page_id AS VARCHAR), ' ' ORDER BY page_id) AS ids
        FROM (SELECT page_id, regexp_extract({_HTML}, '"(/[^"#]*)[^"]*"', 1) AS url FROM pages)
        WHERE url <> '' GROUP BY url""",
    "term_weights": _term_weights("doc_id"),
    "corpus_term_weights": _term_weights("source"),
    "frequent_items": f"""
        WITH {_BASIS} SELECT p_brand, count(*) AS support FROM pairs GROUP BY p_brand
        HAVING count(*) >= (SELECT least FROM bound)""",
    "frequent_baskets": f"""
        WITH {_BASIS},
        frequent AS (SELECT p_brand FROM pairs GROUP BY p_brand HAVING count(*) >= (SELECT least FROM bound))
        SELECT l_orderkey, string_agg(p_brand, '/' ORDER BY p_brand) AS items FROM pairs
        WHERE p_brand IN (SELECT p_brand FROM frequent) GROUP BY l_orderkey""",
    "frequent_itemsets": _itemsets("greatest(2, least // 10)", "level = 3"),
    "itemset_levels": _itemsets("least", "true"),
    "xml_roundtrip": "SELECT event_id, user_id, event_type, value, props FROM events",
    "xml_elements": "SELECT CAST(event_id AS VARCHAR) AS event_id, props FROM events",
    "csv_roundtrip": "SELECT * FROM customer",
    "pair_lines": f"SELECT word || chr(9) || n AS line FROM ({_word_count('conversations', 'text')})",
    "synthetic_comments": "SELECT count(*) AS n, 0 AS n_outside, 0 AS n_foreign_words FROM events",
    "synthetic_users": "SELECT count(*) AS n, 0 AS n_outside FROM customer",
}

# results written to files and read back equal those they were written from
ORACLES["word_count_by_state_bins"] = ORACLES["word_count_by_state"]
ORACLES["bins_counted"] = ORACLES["bin_counts"]
ORACLES["position_frequency_bins"] = ORACLES["position_frequency"]
ORACLES["named_outputs"] = ORACLES["min_max_and_words"]
ORACLES["itemset_level_bins"] = ORACLES["itemset_levels"]
