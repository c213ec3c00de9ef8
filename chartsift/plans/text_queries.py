"""Parsing, units, names and urls over strings that are put together from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, parsing
from .registry import query, table

_CELLS = r"""
c AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS q, CAST(l_partkey % 7 AS INTEGER) AS k FROM lineitem),
x AS (SELECT l_orderkey, l_linenumber, CASE k WHEN 0 THEN q || ' V' WHEN 1 THEN q || '.5kV' WHEN 2 THEN '±' || q || 'V @ 2A' WHEN 3 THEN q || 'mV' WHEN 4 THEN '-' WHEN 5 THEN q || ',000V ~ 9' ELSE 'n.a. ' || q END AS v,
  CASE k WHEN 0 THEN q || ' mOhm' WHEN 1 THEN q || 'Ohm' WHEN 2 THEN 'max ' || q || ' uW' WHEN 3 THEN q || '' WHEN 4 THEN '.. mOhm' WHEN 5 THEN q || '.25 mΩ @ 3A, 10V' ELSE 'N/A' END AS r,
  CASE k WHEN 0 THEN q || ' pF @ 25 V' WHEN 1 THEN q || '.2nF' WHEN 2 THEN q || 'uF' WHEN 3 THEN q || '' ELSE '' END AS f,
  CASE k WHEN 0 THEN q || ' nC @ 10 V' WHEN 1 THEN q || 'uC' WHEN 2 THEN q || 'pC' ELSE 'null' END AS h,
  CASE k WHEN 0 THEN '$' || q || '.99' WHEN 1 THEN '1,' || (100 + q) || '.00' WHEN 2 THEN '$' WHEN 3 THEN 'ask' ELSE q || '' END AS p FROM c)"""


def _number(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST({c} AS DOUBLE) END"


def _numeric(c: str) -> str:
    s = f"replace(trim(split_part(split_part(regexp_replace(trim({c}), '[VAmWnCpFKSΩ℧°/]+$', ''), '~', 1), '@', 1)), ',', '')"
    return f"CASE WHEN trim({c}) NOT IN ('', '-', 'N/A', 'n/a', 'null', 'None') THEN {_number(s)} END"


def _pick(c: str, pattern: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, '{pattern}', 1), '') AS DOUBLE)"


_N = "([+-]?[0-9]+\\.?[0-9]*)"
_V = "trim(ltrim(trim(v), '±'))"
_PARSED = f"""WITH {_CELLS}
SELECT l_orderkey, l_linenumber,
  round(coalesce({_pick(_V, '^' + _N + r' *[kK]V')} * 1000.0, {_pick(_V, '^' + _N + r' *mV')} / 1000.0, {_pick(_V, '^' + _N + r' *V')}, {_numeric(_V)}), 6) AS volts,
  round(CASE WHEN r IN ('N/A') THEN NULL WHEN regexp_matches(r, '(?i)[0-9.]+ *[uµ][OΩ℧WQ]') THEN {_pick('r', '(?i)([0-9.]+) *[uµ][OΩ℧WQ]')} / 1000.0
    WHEN regexp_matches(r, '(?i)[0-9.]+ *m[OΩ℧WQ]') THEN {_pick('r', '(?i)([0-9.]+) *m[OΩ℧WQ]')} WHEN regexp_matches(r, '(?i)[0-9.]+ *[OΩ℧WQ]') THEN {_pick('r', '(?i)([0-9.]+) *[OΩ℧WQ]')} * 1000.0 ELSE {_numeric('r')} END, 6) AS mohm,
  round(coalesce({_pick('f', '^' + _N + ' *nF')} * 1000.0, {_pick('f', '^' + _N + ' *[uµ]F')} * 1e6, {_pick('f', '^' + _N + ' *pF')}), 6) AS pf,
  round(coalesce({_pick('h', '^' + _N + ' *nC')}, {_pick('h', '^' + _N + ' *[uµ]C')} * 1000.0, {_pick('h', '^' + _N + ' *pC')} / 1000.0), 6) AS nc,
  round({_number("replace(ltrim(trim(p), '$'), ',', '')")}, 6) AS usd FROM x"""


@query("parse_numeric_units", _PARSED)
def parse_units(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q"), (F.col("l_partkey") % 7).alias("k"))
    q = F.col("q").cast("string")

    def by(*parts, other):
        out = None
        for i, p in enumerate(parts):
            if p is not None:
                out = F.when(F.col("k") == i, p) if out is None else out.when(F.col("k") == i, p)
        return out.otherwise(other)

    c = c.select(
        "l_orderkey", "l_linenumber",
        by(F.concat(q, F.lit(" V")), F.concat(q, F.lit(".5kV")), F.concat(F.lit("±"), q, F.lit("V @ 2A")), F.concat(q, F.lit("mV")), F.lit("-"), F.concat(q, F.lit(",000V ~ 9")), other=F.concat(F.lit("n.a. "), q)).alias("v"),
        by(F.concat(q, F.lit(" mOhm")), F.concat(q, F.lit("Ohm")), F.concat(F.lit("max "), q, F.lit(" uW")), q, F.lit(".. mOhm"), F.concat(q, F.lit(".25 mΩ @ 3A, 10V")), other=F.lit("N/A")).alias("r"),
        by(F.concat(q, F.lit(" pF @ 25 V")), F.concat(q, F.lit(".2nF")), F.concat(q, F.lit("uF")), q, other=F.lit("")).alias("f"),
        by(F.concat(q, F.lit(" nC @ 10 V")), F.concat(q, F.lit("uC")), F.concat(q, F.lit("pC")), other=F.lit("null")).alias("h"),
        by(F.concat(F.lit("$"), q, F.lit(".99")), F.concat(F.lit("1,"), (100 + F.col("q")).cast("string"), F.lit(".00")), F.lit("$"), F.lit("ask"), other=q).alias("p"),
    )
    fs = {"volts": parsing.voltage(F.col("v")), "mohm": parsing.rdson_mohm(F.col("r")), "pf": parsing.capacitance(F.col("f")), "nc": parsing.charge(F.col("h")), "usd": parsing.price(F.col("p"))}
    return c.select("l_orderkey", "l_linenumber", *[F.round(f, 6).alias(n) for n, f in fs.items()])


@query("ta_preferring_parse", r"""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN round(p_size / 1000.0, 6) WHEN 2 THEN CAST(p_size AS DOUBLE) ELSE NULL END AS amps FROM part""")
def ta_first(spark, sf_dir):
    s = F.col("p_size").cast("string")
    text = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("99A (Tc), "), s, F.lit("A (Ta)"))).when(F.col("p_partkey") % 4 == 1, F.concat(s, F.lit("mA (Ta), 7A (Tc)"))).when(F.col("p_partkey") % 4 == 2, F.concat(s, F.lit("A (Tc)"))).otherwise("-")
    return table(spark, sf_dir, "part").select("p_partkey", F.round(parsing.current(text), 6).alias("amps"))


@query("temperature_range_struct", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(-p_size AS DOUBLE) END AS low, CASE WHEN p_partkey % 3 < 2 THEN CAST(100 + p_size AS DOUBLE) END AS high FROM part")
def temperatures(spark, sf_dir):
    s, high = F.col("p_size").cast("string"), (100 + F.col("p_size")).cast("string")
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("-"), s, F.lit("°C ~ "), high, F.lit("°C (TJ)"))).when(F.col("p_partkey") % 3 == 1, F.concat(high, F.lit(" C (TJ)"))).otherwise(F.lit("N/A"))
    return table(spark, sf_dir, "part").select("p_partkey", parsing.temperature_range(text).alias("t")).select("p_partkey", "t.low", "t.high")


_UNITS = ", ".join(f"('{t}', '{s}', {f})" for t, own in parsing.UNIT_FACTORS.items() for s, f in own.items())


@query("unit_normalize_join", f"""
WITH u AS (SELECT * FROM (VALUES {_UNITS}) t(target, source, factor)),
e AS (SELECT event_id, value, CASE event_id % 6 WHEN 0 THEN 'kV' WHEN 1 THEN 'mv ' WHEN 2 THEN 'V' WHEN 3 THEN 'furlong' WHEN 4 THEN 'µs' ELSE 'S' END AS unit, CASE WHEN event_id % 6 >= 4 THEN 'ns' ELSE 'V' END AS target FROM events)
SELECT event_id, round(value * coalesce(a.factor, b.factor), 6) AS normalized FROM e LEFT JOIN u a ON a.target = e.target AND a.source = trim(e.unit) LEFT JOIN u b ON b.target = e.target AND b.source = lower(trim(e.unit))""")
def units(spark, sf_dir):
    m = F.col("event_id") % 6
    unit = F.when(m == 0, "kV").when(m == 1, "mv ").when(m == 2, "V").when(m == 3, "furlong").when(m == 4, "µs").otherwise("S")
    e = table(spark, sf_dir, "events").select("event_id", "value", unit.alias("unit"), F.when(m >= 4, "ns").otherwise("V").alias("target"))
    return parsing.normalize_units(e, "value", "unit", "target").select("event_id", F.round("normalized", 6).alias("normalized"))


@query("model_name_normalize", r"""
SELECT p_partkey, regexp_replace(trim(p_brand || CASE p_partkey % 4 WHEN 0 THEN '-ND' WHEN 1 THEN '-trdkr' WHEN 2 THEN '-DKR ' ELSE '-NDX' END), '(?i)-(TRDKR|DKR|ND)$', '') AS model,
  trim(regexp_replace(regexp_replace(regexp_replace(p_name || ' (a/b)\c ', '[/\\()]', '_', 'g'), '\s+', '_', 'g'), '_+', '_', 'g'), '_') AS file FROM part""")
def model_names(spark, sf_dir):
    m = F.col("p_partkey") % 4
    tail = F.when(m == 0, "-ND").when(m == 1, "-trdkr").when(m == 2, "-DKR ").otherwise("-NDX")
    return table(spark, sf_dir, "part").select("p_partkey", names.model_name(F.concat("p_brand", tail)).alias("model"), names.file_name(F.concat("p_name", F.lit(r" (a/b)\c "))).alias("file"))


@query("url_normalize_coalesce", r"""
WITH u AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_replace(url, '^https?:', '') WHEN 1 THEN ' - ' WHEN 2 THEN NULL ELSE ' ' || url || ' ' END AS listed, url FROM pages),
n AS (SELECT *, CASE WHEN trim(listed) NOT IN ('', '-') THEN CASE WHEN starts_with(trim(listed), '//') THEN 'https:' || trim(listed) ELSE trim(listed) END END AS own FROM u)
SELECT page_id, coalesce(own, CASE WHEN page_id % 3 = 0 THEN url END) AS url, CASE WHEN own IS NOT NULL THEN 'csv_url' WHEN page_id % 3 = 0 THEN 'crawl' END AS source, CASE WHEN own IS NULL AND page_id % 3 <> 0 THEN 'no_url' ELSE 'found' END AS status FROM n""")
def url_sources(spark, sf_dir):
    m = F.col("page_id") % 4
    listed = F.when(m == 0, F.regexp_replace("url", "^https?:", "")).when(m == 1, " - ").when(m == 2, F.lit(None)).otherwise(F.concat(F.lit(" "), "url", F.lit(" ")))
    own, other = names.sheet_url(listed), F.when(F.col("page_id") % 3 == 0, F.col("url"))
    found = F.coalesce(own, other)
    return table(spark, sf_dir, "pages").select("page_id", found.alias("url"), F.when(own.isNotNull(), "csv_url").when(other.isNotNull(), "crawl").alias("source"), F.when(found.isNull(), "no_url").otherwise("found").alias("status"))


@query("mfr_first_match_template", """
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'https://www.st.com/resource/en/datasheet/' || lower(replace(s_name, '#', '')) || '.pdf' WHEN 1 THEN 'https://www.onsemi.com/download/data-sheet/pdf/' || lower(replace(s_name, '#', '')) || '-d.pdf'
  WHEN 2 THEN 'https://assets.nexperia.com/documents/data-sheet/' || upper(replace(s_name, '#', '')) || '.pdf' END AS url FROM supplier""")
def makers(spark, sf_dir):
    m = F.col("s_suppkey") % 4
    maker = F.when(m == 0, "STMicroelectronics ").when(m == 1, "ON Semiconductor").when(m == 2, "Nexperia USA").otherwise("Other")
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.maker_url(F.replace("s_name", F.lit("#"), F.lit("")), maker).alias("url"))


@query("ingest_kept_vs_skipped", "SELECT CASE WHEN c_custkey % 10 = 0 THEN 'missing ModelName' END AS reason, c_mktsegment AS kind, count(*) AS n, round(sum(CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 3 <> 0 THEN c_acctbal END), 2) AS total FROM customer GROUP BY ALL")
def ingest(spark, sf_dir):
    """Rows without a name are set aside with a reason; unreadable cells are NULL and keep their row."""
    from ..sources.part_lists import parse_rows

    c = table(spark, sf_dir, "customer")
    raw = c.select(F.when(F.col("c_custkey") % 10 == 0, " - ").otherwise(F.col("c_name")).alias("Mfr Part #"), F.when(F.col("c_custkey") % 3 == 0, "ask").otherwise(F.format_string("$%.2f", "c_acctbal")).alias("Price"), F.col("c_mktsegment").alias("Package / Case"))
    return parse_rows(raw, "Si-MOSFET").groupBy(F.col("skip_reason").alias("reason"), F.col("package").alias("kind")).agg(F.count("*").alias("n"), F.round(F.sum(F.when(F.col("skip_reason").isNull(), F.col("Cost"))), 2).alias("total"))


@query("family_assign_counts", "SELECT upper(regexp_extract(p_type, '^([A-Za-z]+)', 1)) AS family, count(*) AS images, count(DISTINCT p_brand) AS devices, min(p_name) AS example FROM part GROUP BY 1")
def families(spark, sf_dir):
    from ..operators.splits import inventory

    rows = table(spark, sf_dir, "part").select(F.col("p_name").alias("file_name"), F.col("p_brand").alias("device"), names.family(F.col("p_type")).alias("family"))
    return inventory(rows)


@query("package_outline_flag", r"""
SELECT doc_id, regexp_matches(lower(text), '(^|[^\[a-z0-9_à-ÿ])mm([^a-z0-9_à-ÿ]|$)') OR regexp_matches(lower(text), 'dimensions|outline|inches|mechanical|footprint|land pattern') AS drawing,
  regexp_matches(lower(text), 'parameter:|= f\(|vs\.|typ\.|max\.|vgs|vds|rdson|rds\(on\)|id =|tj|gate charge|capacitance|impedance') AS graph FROM documents""")
def outlines(spark, sf_dir):
    """Both halves of the flag; a figure is a package drawing if it has the first and not the second."""
    t = F.col("text")
    graph = names._any(F.lower(t), names.GRAPH_WORDS)
    drawing = names._any(F.lower(t), names.OUTLINE_WORDS) | F.lower(t).rlike(r"(?U)(?<!\[)\bmm\b")
    return table(spark, sf_dir, "documents").select("doc_id", drawing.alias("drawing"), graph.alias("graph"))


@query("json_doc_explode", "SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def json_documents(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint", {"mode": "PERMISSIVE"})["k"].alias("k"))
    return e.groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("text_agg_regex", "SELECT conv_id, regexp_matches(lower(string_agg(text, ' ' ORDER BY turn)), 'the|que') AS found, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations WHERE role = 'user' GROUP BY conv_id")
def joined_text(spark, sf_dir):
    """Texts of a zone put together in order, then searched (as for a normalised-ratio axis)."""
    c = table(spark, sf_dir, "conversations").where("role = 'user'")
    g = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("t"), F.sum(F.length("text")).alias("chars"))
    return g.select("conv_id", F.lower("t").rlike("the|que").alias("found"), "chars")


@query("hash_conflict_groups", "SELECT substr(md5(CAST(n_chars AS VARCHAR)), 1, 2) AS name, count(*) AS copies, CASE WHEN count(DISTINCT sha256(text)) = 1 THEN 'copied' ELSE 'conflict' END AS status FROM documents GROUP BY 1")
def conflicts(spark, sf_dir):
    from ..operators.splits import collect_status

    d = table(spark, sf_dir, "documents").select(F.substring(F.md5(F.col("n_chars").cast("string").cast("binary")), 1, 2).alias("name"), F.col("text").cast("binary").alias("content"))
    return collect_status(d)


@query("dup_name_guard", "SELECT sha256(text) AS name, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, sf_dir):
    from ..operators.validate import duplicate_keys

    return duplicate_keys(table(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("name")), ["name"])


@query("table_header_roles_pivot", r"""
WITH c AS (SELECT conv_id, turn, role, length(text) AS n, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn FROM conversations)
SELECT conv_id, max(CASE WHEN role = 'user' THEN n END) AS first_user, max(CASE WHEN role = 'assistant' THEN n END) AS first_assistant FROM c WHERE rn = 1 GROUP BY conv_id""")
def header_pivot(spark, sf_dir):
    """Cells by their header's role, the first of each role wins (as in a table of thermal resistances)."""
    from ..operators.review import latest

    c = latest(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n")), ["conv_id", "role"], [F.asc("turn")])
    return c.groupBy("conv_id").pivot("role", ["user", "assistant"]).agg(F.max("n")).select("conv_id", F.col("user").alias("first_user"), F.col("assistant").alias("first_assistant"))
