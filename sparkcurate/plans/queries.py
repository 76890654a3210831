"""Named queries over the driver's tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import jsontext, text
from ..operators import ab, assemble, catalog, decontam, expand, metrics, ordering, publish
from ..streaming import windows

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def inline(spark: SparkSession, rows: list[str], names: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")


SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def key_sql(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '{SPACE}', ' ', 'g'))"


def tidy_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


def docs_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "lang", "source", text.loose_key(F.col("text")).alias("key"))


DOCS = f"d AS (SELECT doc_id, text, lang, source, {key_sql('text')} AS key FROM documents)"


@query("loose_key", f"WITH {DOCS} SELECT doc_id, key FROM d")
def _(spark, sf):
    return docs_key(spark, sf).select("doc_id", "key")


@query("whitespace_hygiene", f"SELECT conv_id, turn, {tidy_sql('text')} AS tidy FROM conversations")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.hygiene(F.col("text")).alias("tidy"))


@query("keep_first_dedupe", f"WITH {DOCS} SELECT min(doc_id) AS doc_id, source, key FROM d GROUP BY source, key")
def _(spark, sf):
    return ordering.keep_first_id(docs_key(spark, sf), ["source", "key"], "doc_id").select("doc_id", "source", "key")


@query(
    "decontaminate_topk",
    f"""WITH {DOCS}, h AS (SELECT DISTINCT key FROM d WHERE doc_id % 17 = 0),
    f AS (SELECT key, min(doc_id) AS doc_id FROM d WHERE doc_id % 17 <> 0 GROUP BY key),
    c AS (SELECT d.doc_id, d.lang FROM d JOIN f USING (doc_id) WHERE d.key NOT IN (SELECT key FROM h))
    SELECT doc_id, lang FROM c QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('7|' || doc_id), doc_id) <= 50""",
)
def decontaminate_topk(spark, sf):
    """Distinct documents that aren't held out, 50 of each language in hash order."""
    docs = docs_key(spark, sf).select("doc_id", "lang", decontam.digest("key").alias("key"))
    first = ordering.keep_first_id(docs.where("doc_id % 17 <> 0"), ["key"], "doc_id", keep=("lang",))
    clean = decontam.drop_keys(first, docs.where("doc_id % 17 = 0"))
    return ordering.top_k(clean.withColumn("o", ordering.hash_order(7, "doc_id")), ["lang"], ["o", "doc_id"], 50).select("doc_id", "lang")


@query("heldout_collisions", f"WITH {DOCS} SELECT doc_id, key FROM d WHERE doc_id % 17 <> 0 AND key IN (SELECT key FROM d WHERE doc_id % 17 = 0)")
def _(spark, sf):
    docs = docs_key(spark, sf).select("doc_id", "key", decontam.digest("key").alias("d"))
    return decontam.heldout_collisions(docs.where("doc_id % 17 <> 0"), docs.where("doc_id % 17 = 0"), "d").select("doc_id", "key")


#: Held-out documents, those of the corpus, and the candidates, by remainders of 7; keywords are two frequent words.
HIT_WORDS = ("is", "un")
JUDGED = f"""{DOCS}, c AS (SELECT source, doc_id, {tidy_sql('text')} AS text, {key_sql(tidy_sql('text'))} AS key FROM documents WHERE doc_id % 7 > 1),
    u AS (SELECT * FROM c WHERE text <> '' AND key <> '' QUALIFY row_number() OVER (PARTITION BY source, key ORDER BY doc_id) = 1),
    j AS (SELECT source, doc_id, key, CASE
        WHEN len(list_intersect(list_filter(string_split_regex(regexp_replace(lower(translate(text, '''’', '  ')), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '{SPACE}'), lambda w: w <> ''), ['is', 'un'])) = 2 THEN 'keyword'
        WHEN key IN (SELECT key FROM d WHERE doc_id % 7 = 0) OR nkey IN (SELECT key FROM d WHERE doc_id % 7 = 0) THEN 'eval' WHEN key IN (SELECT key FROM d WHERE doc_id % 7 = 1) OR nkey IN (SELECT key FROM d WHERE doc_id % 7 = 1) THEN 'corpus' ELSE 'kept' END AS verdict
        FROM (SELECT *, {key_sql("regexp_replace(text, ' [^ ]*$', '')")} AS nkey FROM u)),
    w AS (SELECT *, coalesce(sum(CASE WHEN verdict = 'kept' THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM j)"""


#: A normal form that differs from the text: without the last word.
def NORMAL(x: Column) -> Column:  # noqa: N802
    return F.regexp_replace(x, " [^ ]*$", "")


def judged(spark, sf):
    docs = docs_key(spark, sf)
    cands = docs.where("doc_id % 7 > 1").select("source", "doc_id", "text")
    hit = text.keyword_hit(F.col("text"), all_of=[list(HIT_WORDS)])
    return cands, decontam.judged(cands, docs.where("doc_id % 7 = 0"), docs.where("doc_id % 7 = 1"), hit, NORMAL(F.col("text")), "source", "doc_id")


@query("filter_candidates", f"WITH {JUDGED} SELECT source, doc_id, key FROM w WHERE verdict = 'kept' AND before < 20")
def _(spark, sf):
    return decontam.filter_candidates(judged(spark, sf)[1], 20, "source", "doc_id").select("source", "doc_id", "key")


@query(
    "filter_stats",
    f"""WITH {JUDGED}, r AS (SELECT source, count(*) AS raw FROM c GROUP BY source)
    SELECT r.source, any_value(raw) AS raw, count(w.doc_id) AS deduped, count_if(verdict = 'keyword') AS keyword_hits,
      count_if(verdict = 'eval' AND before < 20) AS eval_collisions, count_if(verdict = 'corpus' AND before < 20) AS corpus_collisions, count_if(verdict = 'kept' AND before < 20) AS kept
    FROM r LEFT JOIN w USING (source) GROUP BY r.source""",
)
def _(spark, sf):
    cands, rows = judged(spark, sf)
    return decontam.filter_stats(cands, rows, 20, "source", "doc_id")


TEMPLATES = ["('what is the capital of {}')", "('who governs {}')", "('how large is {}')", "('tell me about the history of {}')"]


@query(
    "template_cross",
    f"SELECT n_nationkey, t.template, replace(t.template, '{{}}', n_name) AS text FROM nation, (VALUES {', '.join(TEMPLATES)}) t(template)",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("entity"))
    return expand.template_cross(inline(spark, TEMPLATES, "template"), nations).select("n_nationkey", "template", "text")


#: Frames of a small catalogue: id, text, argument, cap. Slots: nations, regions, brands, whole numbers.
FRAMES = [
    ("f1", "fly from {NATION} to {REGION}", "{NATION}", 12),
    ("f2", "show parts of {BRAND} under {N} coins", "{N}", 12),
    ("f3", "just say hello", "", 12),
    ("f4", "{REGION} or {REGION} again, {NATION}", "{REGION}", 4),
    ("f5", "what about {BRAND}", "{NATION}", 9),
]
SLOTS_SQL = """slots AS (SELECT DISTINCT 'NATION' AS slot, lower(n_name) AS surface, CAST(n_nationkey AS VARCHAR) AS canonical FROM nation
    UNION ALL SELECT DISTINCT 'REGION', lower(r_name), CAST(r_regionkey AS VARCHAR) FROM region
    UNION ALL SELECT DISTINCT 'BRAND', p_brand, upper(p_brand) FROM part
    UNION ALL SELECT 'N', CAST(v AS VARCHAR), CAST(v AS VARCHAR) FROM range(5, 25) t(v))"""
FRAMES_SQL = "frames AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in FRAMES) + ") t(frame_id, text, arg, cap))"
_P = r"\{([A-Z][A-Z0-9_]*)\}"
EXPAND_SQL = f"""{SLOTS_SQL}, {FRAMES_SQL},
    refs AS (SELECT frame_id, text, arg, cap, unnest(list_distinct(list_concat(regexp_extract_all(text, '{_P}', 1), regexp_extract_all(arg, '{_P}', 1)))) AS slot FROM frames),
    picks AS (SELECT * FROM (SELECT refs.frame_id, refs.slot, cap, surface, canonical, row_number() OVER (PARTITION BY frame_id, refs.slot
        ORDER BY md5('11|' || frame_id || '|' || refs.slot || '|' || canonical || '|' || surface), canonical, surface) - 1 AS rk FROM refs JOIN slots USING (slot)) WHERE rk < cap),
    banks AS (SELECT frame_id, slot, list(struct_pack(s := surface, c := canonical) ORDER BY rk) AS vals, count(*) AS n FROM picks GROUP BY frame_id, slot),
    depth AS (SELECT frame_id, max(n) AS depth FROM banks GROUP BY frame_id),
    rows AS (SELECT f.frame_id, i, f.text, f.arg FROM frames f JOIN depth USING (frame_id), range(0, 100) t(i) WHERE i < depth),
    steps AS (SELECT frame_id, i, list(slot ORDER BY slot) AS names, list(vals[(i % n) + 1] ORDER BY slot) AS vals FROM rows JOIN banks USING (frame_id) GROUP BY frame_id, i),
    filled AS (SELECT frame_id, CAST(i AS BIGINT) AS i,
        list_reduce(list_prepend(text, list_transform(range(1, len(names) + 1), lambda k: chr(1) || names[k] || chr(2) || vals[k].s)), lambda a, x: replace(a, '{{' || string_split(x[2:], chr(2))[1] || '}}', string_split(x, chr(2))[2])) AS text,
        list_reduce(list_prepend(arg, list_transform(range(1, len(names) + 1), lambda k: chr(1) || names[k] || chr(2) || vals[k].c)), lambda a, x: replace(a, '{{' || string_split(x[2:], chr(2))[1] || '}}', string_split(x, chr(2))[2])) AS arg
      FROM rows JOIN steps USING (frame_id, i)
      UNION ALL SELECT frame_id, 0, text, arg FROM frames WHERE frame_id NOT IN (SELECT frame_id FROM refs))"""


def frames(spark):
    rows = [f"('{a}', '{b}', map('a', '{c}'), {d})" for a, b, c, d in FRAMES]
    return inline(spark, rows, "frame_id, text, args, cap")


def slots(spark, sf):
    nation = table(spark, sf, "nation").select(F.lit("NATION").alias("slot"), F.lower("n_name").alias("surface"), F.col("n_nationkey").cast("string").alias("canonical"))
    region = table(spark, sf, "region").select(F.lit("REGION").alias("slot"), F.lower("r_name").alias("surface"), F.col("r_regionkey").cast("string").alias("canonical"))
    brand = table(spark, sf, "part").select(F.lit("BRAND").alias("slot"), F.col("p_brand").alias("surface"), F.upper("p_brand").alias("canonical")).distinct()
    numbers = expand.int_slots(inline(spark, ["('N', 5L, 24L)"], "slot, min, max")).select("slot", "surface", "canonical")
    return nation.unionByName(region).unionByName(brand).unionByName(numbers)


@query("frame_expand", f"WITH {EXPAND_SQL} SELECT frame_id, i, text, arg FROM filled")
def _(spark, sf):
    f = frames(spark)
    expand.check_slots(f, slots(spark, sf), ["frame_id"])
    return expand.expand_frames(f, slots(spark, sf), 11, ["frame_id"]).select("frame_id", "i", "text", F.col("args")["a"].alias("arg"))


@query("int_slot_expand", "SELECT n_name AS slot, CAST(v - n_regionkey AS BIGINT) AS val_ord, CAST(v AS VARCHAR) AS surface FROM nation, range(0, 200) t(v) WHERE v BETWEEN n_regionkey AND n_regionkey + n_nationkey")
def _(spark, sf):
    lo = F.col("n_regionkey").cast("long")
    return expand.int_slots(table(spark, sf, "nation").select(F.col("n_name").alias("slot"), lo.alias("min"), (lo + F.col("n_nationkey")).alias("max"))).select("slot", "val_ord", "surface")


@query(
    "expand_accept",
    f"""WITH {EXPAND_SQL}, k AS (SELECT *, {key_sql('text')} AS key FROM filled),
    f AS (SELECT *, md5('12|' || frame_id || '|' || i) AS o FROM k QUALIFY row_number() OVER (PARTITION BY frame_id, key ORDER BY md5('12|' || frame_id || '|' || i), frame_id, i) = 1)
    SELECT frame_id, i, key FROM f WHERE NOT (frame_id = 'f5' AND key LIKE '%1%') AND key NOT LIKE '%asia%'
    QUALIFY row_number() OVER (PARTITION BY frame_id ORDER BY o, frame_id, i) <= 6""",
)
def _(spark, sf):
    pool = expand.expand_frames(frames(spark), slots(spark, sf), 11, ["frame_id"]).withColumn("key", text.loose_key(F.col("text")))
    seen = pool.where("frame_id = 'f5' AND key LIKE '%1%'").select("frame_id", "key")
    return expand.accept(pool, seen, pool.where("key LIKE '%asia%'").select("key"), "frame_id", 12, F.lit(6), ["frame_id", "i"]).select("frame_id", "i", "key")


@query(
    "expand_shortfall",
    f"""WITH {EXPAND_SQL}, k AS (SELECT frame_id, count(DISTINCT {key_sql('text')}) AS kept FROM filled GROUP BY frame_id)
    SELECT frame_id, CAST(10 AS BIGINT) AS target, coalesce(kept, 0) AS kept, coalesce(kept, 0) < 10 AS short FROM frames LEFT JOIN k USING (frame_id)""",
)
def _(spark, sf):
    pool = expand.expand_frames(frames(spark), slots(spark, sf), 11, ["frame_id"]).select("frame_id", text.loose_key(F.col("text")).alias("key")).distinct()
    return expand.shortfall(frames(spark).select("frame_id", F.lit(10).alias("target")), pool, "frame_id")


@query(
    "placeholder_refs",
    """WITH f AS (SELECT p_partkey, '{BRAND} of {' || p_type || '} or {' || upper(replace(p_name, ' ', '_')) || '}, {small}, {BRAND}' AS text, '{A' || p_size || '} {BRAND}' AS arg FROM part),
    r AS (SELECT p_partkey, list_concat(regexp_extract_all(text, 'PATTERN', 1), regexp_extract_all(arg, 'PATTERN', 1)) AS l FROM f)
    SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS refs FROM r""".replace("PATTERN", _P),
)
def _(spark, sf):
    name = F.upper(F.replace("p_name", F.lit(" "), F.lit("_")))
    texts = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("{BRAND} of {"), "p_type", F.lit("} or {"), name, F.lit("}, {small}, {BRAND}")).alias("text"), F.create_map(F.lit("a"), F.concat(F.lit("{A"), F.col("p_size").cast("string"), F.lit("} {BRAND}"))).alias("args"))
    return texts.select("p_partkey", F.array_join(text.placeholders(F.col("text"), F.col("args")), ",").alias("refs"))


@query("undefined_slots", f"WITH {EXPAND_SQL} SELECT DISTINCT frame_id, slot FROM refs WHERE slot NOT IN (SELECT slot FROM slots WHERE slot <> 'BRAND')")
def _(spark, sf):
    return expand.undefined_slots(frames(spark), slots(spark, sf).where("slot <> 'BRAND'"), ["frame_id"])


@query("duplicate_owner", "SELECT p_name, count(DISTINCT p_brand) AS owners FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1")
def _(spark, sf):
    return catalog.duplicate_owners(table(spark, sf, "part"), "p_name", "p_brand")


@query(
    "trigger_offenders",
    rf"""SELECT doc_id, len(list_intersect(list_filter(string_split_regex(regexp_replace(lower(translate(text, '''’', '  ')), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '{SPACE}'), lambda w: w <> ''), ['quando', 'was', 'und'])) > 0
      OR regexp_matches(lower(text), 'copyright|apache') OR regexp_matches(text, '[\p{{Nd}}²³¹⁰-⁹₀-₉]') AS offends FROM documents""",
)
def _(spark, sf):
    offends = text.trigger_offender(F.col("text"), ["quando", "was", "und"], ["copyright", "apache"])
    return table(spark, sf, "documents").select("doc_id", offends.alias("offends"))


@query("anchored_rule", r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9]') AND NOT regexp_matches(lower(text), 'license|version|page')")
def _(spark, sf):
    return table(spark, sf, "documents").where(text.unanchored(F.col("text"), "[0-9]", "license|version|page")).select("doc_id")


@query("banned_shape", "SELECT doc_id, source FROM documents WHERE text IN (SELECT text FROM documents WHERE doc_id % 50 = 0) AND source <> 'src0'")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return decontam.banned_elsewhere(docs, docs.where("doc_id % 50 = 0"), "text", "source", "src0").select("doc_id", "source")


@query("merge_priority", "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def _(spark, sf):
    own = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return catalog.merge_priority(own, table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))


@query("eligible_default", "SELECT o_orderkey FROM orders WHERE coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 3 = 1 END, TRUE)")
def _(spark, sf):
    flag = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 3 == 1)
    return catalog.eligible(table(spark, sf, "orders").withColumn("router_eligible", flag)).select("o_orderkey")


@query(
    "assign_alias",
    """WITH p AS (SELECT p_partkey, p_brand || '.' || p_name AS id, string_split(p_brand || '.' || p_name, '.')[-1] AS seg FROM part)
    SELECT p_partkey, id, CASE WHEN count(*) OVER (PARTITION BY seg) = 1 THEN seg ELSE id END AS alias FROM p""",
)
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.concat_ws(".", "p_brand", "p_name").alias("id"))
    return catalog.assign_alias(parts)


@query(
    "infer_params",
    """WITH e AS (SELECT event_type, event_id, json_keys(props) AS ks FROM events), k AS (SELECT event_type, event_id, unnest(ks) AS name, generate_subscripts(ks, 1) AS pos FROM e),
    f AS (SELECT event_type, name, min(event_id * 1000 + pos) AS ord FROM k GROUP BY event_type, name)
    SELECT event_type AS skill_id, array_to_string(list(name ORDER BY ord), ',') AS names,
      '{"type": "object", "properties": {' || string_agg('"' || name || '": {"type": "string"}', ', ' ORDER BY ord) || '}, "required": [' || string_agg('"' || name || '"', ', ' ORDER BY ord) || ']}' AS schema
    FROM f GROUP BY event_type""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("skill_id"), F.col("event_id").alias("ex_ord"), F.from_json("props", "map<string,string>").alias("args"))
    return catalog.infer_params(events).select("skill_id", F.array_join("names", ",").alias("names"), "schema")


PARAMETERS = '{"type": "object", "properties": {"size": {"type": "string"}}}'
FINGER = """sha256('{"description": ' || to_json(min_type) || ', "examples": [' || array_to_string(list_transform(list_sort(names), lambda n: to_json(n)), ', ') || '], "id": ' || to_json(p_brand)
    || ', "parameters": {"properties": {"size": {"type": "string"}}, "type": "object"}}')"""


def fingerprints(parts: DataFrame) -> DataFrame:
    grouped = parts.groupBy(F.col("p_brand").alias("skill_id")).agg(F.min("p_type").alias("kind"), F.collect_set("p_name").alias("names"))
    return grouped.select("skill_id", catalog.fingerprint(F.col("skill_id"), F.col("kind"), F.lit(PARAMETERS), F.col("names")).alias("sha256"))


def prints(source: str) -> str:
    return f"(SELECT p_brand AS skill_id, {FINGER} AS sha256 FROM (SELECT p_brand, min(p_type) AS min_type, list(DISTINCT p_name) AS names FROM {source} GROUP BY p_brand))"


@query("fingerprint", f"SELECT * FROM {prints('part')}")
def _(spark, sf):
    return fingerprints(table(spark, sf, "part"))


@query(
    "drift_audit",
    f"""WITH s AS {prints('part')}, o AS {prints("(SELECT p_brand, p_type, CASE WHEN p_partkey = 7 THEN p_name || ' new' ELSE p_name END AS p_name FROM part)")},
    k AS (SELECT * FROM s WHERE right(skill_id, 1) <> '1'), b AS (SELECT DISTINCT p_brand AS skill_id FROM part WHERE right(p_brand, 1) <> '2')
    SELECT coalesce(k.skill_id, b.skill_id) AS skill_id, CASE WHEN k.skill_id IS NULL THEN 'orphaned' WHEN b.skill_id IS NULL THEN 'missing' WHEN k.sha256 IS NOT DISTINCT FROM o.sha256 THEN 'ok' ELSE 'stale' END AS status
    FROM k FULL JOIN b ON k.skill_id = b.skill_id LEFT JOIN o ON o.skill_id = coalesce(k.skill_id, b.skill_id)""",
)
def _(spark, sf):
    parts = table(spark, sf, "part")
    old = fingerprints(parts.withColumn("p_name", F.when(F.col("p_partkey") == 7, F.concat("p_name", F.lit(" new"))).otherwise(F.col("p_name"))))
    skills = fingerprints(parts).where(F.right("skill_id", F.lit(1)) != "1")
    banks = parts.select(F.col("p_brand").alias("skill_id")).where(F.right("skill_id", F.lit(1)) != "2")
    return catalog.drift(skills, banks, old)


@query("ledger_upsert", "SELECT coalesce(n.k, o.k) AS k, coalesce(n.v, o.v) AS v FROM (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_custkey % 2 = 0) o FULL JOIN (SELECT c_custkey AS k, upper(c_name) AS v FROM customer WHERE c_custkey % 3 = 0) n ON o.k = n.k")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return catalog.ledger_upsert(c.where("k % 2 = 0"), c.where("k % 3 = 0").withColumn("v", F.upper("v")), ["k"], "v")


@query(
    "negative_target",
    """SELECT p_brand, ratio, n, CASE WHEN n < 50 THEN 250 ELSE CAST(round_even(n * ratio, 0) AS BIGINT) END AS target
    FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand), (VALUES (CAST(0.5 AS DOUBLE)), (1.0), (1.5)) r(ratio)""",
)
def _(spark, sf):
    n = table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    ratios = inline(spark, ["(0.5D)", "(1.0D)", "(1.5D)"], "ratio")
    return n.crossJoin(F.broadcast(ratios)).withColumn("target", assemble.negative_target(F.col("n"), F.col("ratio")))


@query("sample_negatives", "SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY md5('5|' || doc_id), doc_id LIMIT 150)")
def _(spark, sf):
    return ordering.sample_n(table(spark, sf, "documents").select("doc_id"), 150, 5, "doc_id")


@query("split_ratio", "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('6|' || doc_id), doc_id) <= floor((SELECT count(*) FROM documents) * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'eval' END AS metadata FROM documents")
def _(spark, sf):
    return ordering.split_ratio(table(spark, sf, "documents").select("doc_id"), 0.9, 6, "doc_id")


@query("first_user_turn", "SELECT conv_id, text FROM conversations WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1")
def _(spark, sf):
    return assemble.first_user_turn(table(spark, sf, "conversations"))


@query("corpus_keys", f"SELECT DISTINCT {key_sql('text')} AS key FROM (SELECT text FROM conversations WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1)")
def _(spark, sf):
    return assemble.first_user_turn(table(spark, sf, "conversations")).select(text.loose_key(F.col("text")).alias("key")).distinct()


@query(
    "prompt_completion",
    """WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations),
    l AS (SELECT conv_id, text AS completion FROM t WHERE back = 1 AND role = 'assistant' AND trim(text) <> ''),
    p AS (SELECT conv_id, string_agg('<start_of_turn>' || role || chr(10) || text || '<end_of_turn>' || chr(10), '' ORDER BY turn) AS p FROM t WHERE back > 1 GROUP BY conv_id)
    SELECT conv_id, coalesce(p, '') || '<start_of_turn>assistant' || chr(10) AS prompt, completion FROM l LEFT JOIN p USING (conv_id)""",
)
def _(spark, sf):
    return assemble.prompt_completion(table(spark, sf, "conversations"))


@query(
    "assemble_samples",
    """SELECT conv_id, 3 AS n_messages, 'developer,user,assistant' AS roles, 'rules of ' || conv_id AS developer, text AS user_text, CASE WHEN conv_id % 2 = 0 THEN 'tool' || (conv_id % 5) END AS call_name,
      CASE WHEN conv_id % 2 = 0 THEN '{"a":"' || conv_id || '","b":"x"}' END AS arguments, CASE WHEN conv_id % 2 = 1 THEN 'no' END AS refusal FROM conversations WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""",
)
def _(spark, sf):
    first = assemble.first_user_turn(table(spark, sf, "conversations"))
    own = F.col("conv_id").cast("string")
    name = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("tool"), (F.col("conv_id") % 5).cast("string")))
    m = assemble.messages(F.col("text"), F.concat(F.lit("rules of "), own), name, F.create_map(F.lit("a"), own, F.lit("b"), F.lit("x")), F.lit("no"))
    rows = first.select("conv_id", m.alias("m"))
    call = F.col("m")[2]["tool_calls"][0]["function"]
    roles = F.array_join(F.transform("m", lambda x: x["role"]), ",")
    return rows.select("conv_id", F.size("m").alias("n_messages"), roles.alias("roles"), F.col("m")[0]["content"].alias("developer"), F.col("m")[1]["content"].alias("user_text"), call["name"].alias("call_name"), F.to_json(call["arguments"]).alias("arguments"), F.col("m")[2]["content"].alias("refusal"))


CALLS_SQL = """c AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'nothing to do' ELSE 'ok <start_function_call>call:' || event_type || CASE WHEN event_id % 7 = 0 THEN '_x' ELSE '' END || '{a:1}' END AS raw FROM events),
    p AS (SELECT event_id, nullif(regexp_extract(raw, '<start_function_call>call:(\\w+)\\{', 1), '') AS name FROM c)"""


def calls(spark, sf):
    name = F.concat(F.lit("ok <start_function_call>call:"), "event_type", F.when(F.col("event_id") % 7 == 0, "_x").otherwise(""), F.lit("{a:1}"))
    return table(spark, sf, "events").withColumn("raw", F.when(F.col("event_id") % 5 == 0, "nothing to do").otherwise(name))


@query("parse_call", f"WITH {CALLS_SQL} SELECT event_id, CASE WHEN name IS NULL THEN '__none__' WHEN name IN (SELECT event_type FROM events) THEN name ELSE '__hallucinated:' || name || '__' END AS predicted FROM p")
def _(spark, sf):
    events = table(spark, sf, "events")
    return metrics.parse_call(calls(spark, sf), events.select(F.col("event_type").alias("name")).distinct()).select("event_id", "predicted")


@query(
    "stratified_accuracy",
    """SELECT lang, grouping(lang) = 1 AS is_total, count(*) AS n, count_if(quality = 1) AS n_correct, count_if(quality = 1) / count(*) AS accuracy
    FROM labels JOIN documents USING (doc_id) GROUP BY ROLLUP (lang)""",
)
def _(spark, sf):
    both = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").withColumn("correct", F.col("quality") == 1)
    return metrics.stratified_accuracy(both, "lang")


VERDICTS = """v AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'spine' ELSE 'generated' END AS source, -value / 1000 AS conf, CASE WHEN event_type = 'error' THEN 'NONE' ELSE event_type END AS expect,
      CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 OR event_type = 'error' THEN 'other' ELSE event_type END AS pick FROM events)"""


def verdicts(spark, sf):
    e = table(spark, sf, "events")
    pick = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string")).when((F.col("event_id") % 13 == 0) | (F.col("event_type") == "error"), "other").otherwise(F.col("event_type"))
    return e.select("event_id", F.when(F.col("event_id") % 2 == 0, "spine").otherwise("generated").alias("source"), (-F.col("value") / 1000).alias("conf"), F.when(F.col("event_type") == "error", "NONE").otherwise(F.col("event_type")).alias("expect"), pick.alias("pick"))


RATES = "CASE WHEN fired = 0 THEN 1 ELSE correct / fired END AS precision, CASE WHEN abst_total = 0 THEN 1 ELSE abst_pass / abst_total END AS abstention, CASE WHEN pos_total = 0 THEN 0 ELSE correct / pos_total END AS recall"


@query(
    "gate_metrics_at_floor",
    f"""WITH {VERDICTS}, m AS (SELECT source, count_if(upper(expect) <> 'NONE' AND pick IS NOT NULL AND conf >= -0.1) AS fired, count_if(upper(expect) <> 'NONE' AND pick = expect AND conf >= -0.1) AS correct,
      count_if(upper(expect) = 'NONE' AND NOT (pick IS NOT NULL AND conf >= -0.1)) AS abst_pass, count_if(upper(expect) = 'NONE') AS abst_total, count_if(upper(expect) <> 'NONE') AS pos_total FROM v GROUP BY source)
    SELECT *, {RATES} FROM m""",
)
def _(spark, sf):
    return metrics.gate_metrics(verdicts(spark, sf), -0.1, ["source"])


#: Definitions: a case fires at a floor if it has a pick and its confidence reaches the floor; precision is over the
#: positives that fire, abstention over all NONE cases, recall over all positives.
SWEEP = """f AS (SELECT DISTINCT conf AS floor FROM v WHERE pick IS NOT NULL),
    p AS (SELECT floor, count_if(upper(expect) <> 'NONE') AS n, count_if(upper(expect) <> 'NONE' AND pick = expect) AS c, count_if(upper(expect) = 'NONE') AS q FROM f JOIN v ON v.conf = f.floor AND v.pick IS NOT NULL GROUP BY floor),
    t AS (SELECT count_if(upper(expect) = 'NONE') AS abst_total, count_if(upper(expect) <> 'NONE') AS pos_total FROM v),
    s AS (SELECT floor, CAST(sum(n) OVER w AS BIGINT) AS fired, CAST(sum(c) OVER w AS BIGINT) AS correct, abst_total - CAST(sum(q) OVER w AS BIGINT) AS abst_pass, abst_total, pos_total FROM p, t WINDOW w AS (ORDER BY floor DESC ROWS UNBOUNDED PRECEDING))"""


@query("floor_sweep", f"WITH {VERDICTS}, {SWEEP} SELECT *, {RATES} FROM s")
def _(spark, sf):
    return metrics.floor_sweep(verdicts(spark, sf))


def derived_sql(precision: str, abstention: str) -> str:
    return f"""WITH {VERDICTS}, {SWEEP}, r AS (SELECT *, {RATES} FROM s), b AS (SELECT min(floor) AS f FROM r WHERE precision >= {precision} AND abstention >= {abstention} AND fired >= 10 AND floor >= -0.5),
    m AS (SELECT count_if(upper(expect) <> 'NONE' AND pick IS NOT NULL AND conf >= f) AS fired, count_if(upper(expect) <> 'NONE' AND pick = expect AND conf >= f) AS correct,
      count_if(upper(expect) = 'NONE' AND NOT (pick IS NOT NULL AND conf >= f)) AS abst_pass, count_if(upper(expect) = 'NONE') AS abst_total FROM v, b WHERE source = 'spine'),
    g AS (SELECT f IS NOT NULL AND (fired = 0 OR correct / fired >= {precision}) AND (abst_total = 0 OR abst_pass / abst_total >= {abstention}) AS good, f FROM m, b)
    SELECT CASE WHEN good THEN f ELSE -0.06 END AS floor, CASE WHEN good THEN 'derived' ELSE 'fallback' END AS source FROM g"""


@query("derive_floor", derived_sql("0.9", "0.9"))
def _(spark, sf):
    return metrics.derive_floor(verdicts(spark, sf), -0.06)


@query("derive_floor_fallback", derived_sql("0.99", "0.9"))
def _(spark, sf):
    return metrics.derive_floor(verdicts(spark, sf), -0.06, precision_min=0.99)


@query("bundle_hash", "SELECT p_brand, sha256(string_agg(name || ':' || sha || ',', '' ORDER BY name, sha)) AS bundle_sha FROM (SELECT p_brand, p_partkey || '' AS name, sha256(p_name) AS sha FROM part) GROUP BY p_brand")
def _(spark, sf):
    files = table(spark, sf, "part").select("p_brand", F.col("p_partkey").cast("string").alias("name"), F.sha2("p_name", 256).alias("sha256"))
    return publish.bundle_hash(files, "p_brand")


@query(
    "manifest_diff",
    """WITH o AS (SELECT p_brand, p_partkey AS name, sha256(p_name) AS was FROM part WHERE p_partkey % 9 <> 0), n AS (SELECT p_brand, p_partkey AS name, upper(sha256(CASE WHEN p_partkey % 10 = 0 THEN p_type ELSE p_name END)) AS now FROM part WHERE p_partkey % 8 <> 0),
    b AS (SELECT p_brand, name, was, now, coalesce(lower(was) = lower(now), FALSE) AS same FROM o FULL JOIN n USING (p_brand, name)),
    g AS (SELECT p_brand, count_if(was IS NULL) AS added, count_if(now IS NULL) AS removed, count_if(was IS NOT NULL AND now IS NOT NULL AND NOT same) AS changed, count_if(same) AS unchanged FROM b GROUP BY p_brand)
    SELECT *, added + removed + changed > 0 OR unchanged = 0 AS publish FROM g""",
)
def _(spark, sf):
    parts = table(spark, sf, "part")
    old = parts.where("p_partkey % 9 <> 0").select("p_brand", F.col("p_partkey").alias("name"), F.sha2("p_name", 256).alias("sha256"))
    new = parts.where("p_partkey % 8 <> 0").select("p_brand", F.col("p_partkey").alias("name"), F.upper(F.sha2(F.when(F.col("p_partkey") % 10 == 0, F.col("p_type")).otherwise(F.col("p_name")), 256)).alias("sha256"))
    return publish.manifest_diff(old, new, "p_brand")


SLICES = " || ':' || ".join(f"sum(CAST('0x' || substr(h, {1 + 15 * k}, 15) AS HUGEINT))" for k in range(4))


@query("content_hash", f"SELECT count(*) AS n, left(sha256(count(*) || ':' || {SLICES}), 16) AS content_hash FROM (SELECT sha256(text) AS h FROM documents)")
def _(spark, sf):
    return publish.multiset_hash(table(spark, sf, "documents"), "text")


@query(
    "ab_compare",
    """WITH x AS (SELECT m.model, b.item_id AS clip, CASE m.model WHEN 'a' THEN lower(text) ELSE trim(text) END AS transcript FROM benchmark b, (VALUES ('a'), ('b')) m(model)),
    s AS (SELECT item_id AS clip, text AS device FROM benchmark WHERE item_id % 3 <> 0)
    SELECT model, clip, device IS NOT NULL AND device IS DISTINCT FROM transcript AS differs FROM x LEFT JOIN s USING (clip)""",
)
def _(spark, sf):
    b = table(spark, sf, "benchmark")
    models = inline(spark, ["('a')", "('b')"], "model")
    clips = b.select(F.col("item_id").alias("clip"))
    spoken = b.select(F.lit("a").alias("model"), F.col("item_id").alias("clip"), F.lower("text").alias("transcript")).unionByName(b.select(F.lit("b").alias("model"), F.col("item_id").alias("clip"), F.trim("text").alias("transcript")))
    side = b.where("item_id % 3 <> 0").select(F.col("item_id").alias("clip"), F.col("text").alias("device"))
    return ab.ab_compare(clips, spoken, side, models).select("model", "clip", "differs")


@query(
    "cpu_cost",
    """WITH w AS (SELECT user_id, event_id % 2 AS half, CAST(floor(sum(value)) AS BIGINT) AS ticks, count(*) AS elapsed FROM events GROUP BY user_id, event_id % 2),
    p AS (SELECT user_id, max(CASE WHEN half = 0 THEN round(ticks / 100 / elapsed * 100, 2) END) AS pct_first, max(CASE WHEN half = 1 THEN round(ticks / 100 / elapsed * 100, 2) END) AS pct_second FROM w GROUP BY user_id)
    SELECT *, round(pct_first - pct_second, 2) AS delta FROM p""",
)
def _(spark, sf):
    # doubles are added in the events' order: a sum that is whole but for rounding has its floor by the order, which must not be that of the tasks
    e = table(spark, sf, "events").select("event_id", "user_id", "value", (F.col("event_id") % 2).cast("string").alias("label"))
    so_far = Window.partitionBy("user_id", "label").orderBy("event_id", "value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumns({"sum": F.sum("value").over(so_far), "n": F.count(F.lit(1)).over(so_far)})
    e = e.groupBy("user_id", "label").agg(F.floor(F.max_by("sum", "n")).alias("ticks"), F.max("n").alias("elapsed"))
    samples = e.withColumns({"clk_tck": F.lit(100), "pid_before": F.lit(1), "pid_after": F.lit(1)})
    return ab.cpu_delta(samples, "user_id", "0", "1")


@query(
    "per_skill_floors",
    """WITH d AS (SELECT doc_id, CASE WHEN source = 'src1' THEN 'NONE' ELSE source END AS source FROM documents), g AS (SELECT DISTINCT source FROM d),
    k AS (SELECT source, count(*) AS kept FROM d JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY source)
    SELECT source, coalesce(kept, 0) AS kept, CASE WHEN source = 'NONE' THEN CASE WHEN coalesce(kept, 0) < 20 THEN 'fatal' ELSE 'ok' END
      WHEN coalesce(kept, 0) < 3 THEN 'fatal' WHEN coalesce(kept, 0) < 10 THEN 'thin' ELSE 'ok' END AS status FROM g LEFT JOIN k USING (source)""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("source") == "src1", "NONE").otherwise(F.col("source")).alias("source"))
    return metrics.per_group_floors(docs.select("source").distinct(), docs.join(table(spark, sf, "labels").where("quality = 0"), "doc_id"), "source")


@query("avoid_list_head", "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20")
def _(spark, sf):
    return ordering.top_k(table(spark, sf, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 20)


LANGS = ["de", "en", "es", "fr"]


def sessions_sql(langs: list[str], quota: int) -> str:
    steps = ["f AS (SELECT min(doc_id) AS doc_id, lang, key FROM d GROUP BY lang, key)"]
    for k, lang in enumerate(langs):
        taken = " UNION ALL ".join(f"SELECT key FROM s{j}" for j in range(k))
        steps.append(f"s{k} AS (SELECT * FROM f WHERE lang = '{lang}'{f' AND key NOT IN ({taken})' if k else ''} ORDER BY doc_id LIMIT {quota})")
    return f"WITH {DOCS}, {', '.join(steps)} SELECT lang, doc_id FROM ({' UNION ALL '.join(f'SELECT * FROM s{k}' for k in range(len(langs)))})"


@query("sequential_sessions", sessions_sql(LANGS, 40))
def _(spark, sf):
    return decontam.sequential_sessions(docs_key(spark, sf).select("doc_id", "lang", "key"), LANGS, 40, "lang", "doc_id").select("lang", "doc_id")


@query("csv_split", "SELECT s_suppkey, array_to_string(list_filter(list_transform(string_split(s_name || ', ,' || s_nationkey || ',', ','), lambda x: trim(x)), lambda y: y <> ''), '|') AS parts FROM supplier")
def _(spark, sf):
    line = F.concat("s_name", F.lit(", ,"), "s_nationkey", F.lit(","))
    return table(spark, sf, "supplier").select("s_suppkey", F.array_join(text.csv_list(line), "|").alias("parts"))


@query("key_value", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'x=' || s_suppkey ELSE s_name END AS value FROM supplier")
def _(spark, sf):
    line = F.when(F.col("s_suppkey") % 2 == 0, F.concat("s_name", F.lit("=x="), "s_suppkey")).otherwise(F.col("s_name"))
    return table(spark, sf, "supplier").select("s_suppkey", text.key_value(line).alias("kv")).select("s_suppkey", "kv.name", "kv.value")


@query("version_strings", "SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') || '-' || left(sha256(CAST(o_orderkey AS VARCHAR)), 7) AS version, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS released_at FROM orders")
def _(spark, sf):
    sha = F.sha2(F.col("o_orderkey").cast("string"), 256)
    return table(spark, sf, "orders").select("o_orderkey", text.version_name(F.col("o_orderdate"), sha).alias("version"), text.iso_utc(F.col("o_orderdate")).alias("released_at"))


@query("article_fusion", "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'della ' || n_name WHEN 1 THEN 'del ' || n_name WHEN 2 THEN 'dell''' || n_name ELSE 'di ' || n_name END AS di, CASE n_nationkey % 4 WHEN 0 THEN 'la ' || n_name WHEN 1 THEN 'il ' || n_name WHEN 2 THEN 'l''' || n_name ELSE n_name END AS the FROM nation")
def _(spark, sf):
    article = F.element_at(F.array(F.lit("la"), F.lit("il"), F.lit("l'"), F.lit("")), (F.col("n_nationkey") % 4 + 1).cast("int"))
    return table(spark, sf, "nation").select("n_nationkey", text.article_di(F.col("n_name"), article).alias("di"), text.article_the(F.col("n_name"), article).alias("the"))


@query("count_windows", "SELECT user_id, CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 16) AS BIGINT) AS w, value FROM events")
def _(spark, sf):
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    return windows.count_windows(table(spark, sf, "events").withColumn("pos", pos), "user_id", "pos", F.col("value").cast("decimal(18,6)"), 16).select("user_id", "window", "n", F.col("total").cast("double").alias("total"))


SQL["count_windows"] = f"WITH w AS ({SQL['count_windows']}) SELECT user_id, w AS \"window\", count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total FROM w GROUP BY user_id, w"


@query("event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("value", F.col("value").cast("decimal(18,6)"))
    return windows.event_windows(e, "1 hour").withColumn("total", F.col("total").cast("double"))


CONTRACTED = ", ".join("('" + a.replace("'", "''") + f"', '{b}')" for a, b in text.CONTRACTIONS.items())
WORTH = ", ".join(f"('{w}', {v})" for v, w in [*enumerate(text.UNITS), *((20 + 10 * k, w) for k, w in enumerate(text.TENS))])


def normal_sql(source: str, ids: str) -> str:
    """The normal form of texts: contractions written out word by word, then a step a word with the text so far, thousands, the part below, and whether a number is open."""
    parts = f"string_split_regex(replace(lower(text), '’', chr(39)), '{SPACE}')"
    return rf"""WITH RECURSIVE source AS ({source}), short AS (SELECT * FROM (VALUES {CONTRACTED}) t(a, b)), worth AS (SELECT * FROM (VALUES {WORTH}) t(w, v)),
    raw AS (SELECT {ids}, unnest({parts}) AS w, generate_subscripts({parts}, 1) AS k FROM source WHERE text IS NOT NULL),
    core AS (SELECT *, regexp_extract(w, '^([\p{{L}}'']*)', 1) AS c FROM raw),
    plain AS (SELECT {ids}, string_agg(coalesce(b, c) || substr(w, length(c) + 1), ' ' ORDER BY k) AS t FROM core LEFT JOIN short ON a = c GROUP BY {ids}),
    keyed AS (SELECT {ids}, {key_sql("replace(t, chr(39), '')")} AS t FROM plain),
    words AS (SELECT {ids}, string_split(t, ' ') AS ws, t FROM keyed),
    num AS (SELECT map_from_entries(list((w, v))) AS m FROM worth),
    step AS (
      SELECT {ids}, CAST(0 AS BIGINT) AS k, '' AS o, CAST(0 AS BIGINT) AS high, CAST(0 AS BIGINT) AS low, FALSE AS open FROM words
      UNION ALL
      SELECT {ids}, k + 1,
        CASE WHEN kind IN ('join', 'hundred', 'thousand') THEN o WHEN kind = 'new' THEN flushed ELSE flushed || ' ' || w END,
        CASE kind WHEN 'join' THEN high WHEN 'hundred' THEN high WHEN 'thousand' THEN low * 1000 ELSE 0 END,
        CASE kind WHEN 'join' THEN low + v WHEN 'new' THEN v WHEN 'hundred' THEN low * 100 ELSE 0 END,
        kind <> 'word'
      FROM (SELECT *, CASE WHEN v IS NOT NULL AND open AND ((low % 100 = 0 AND (low > 0 OR high > 0)) OR (v BETWEEN 1 AND 9 AND low % 100 >= 20 AND low % 10 = 0)) THEN 'join'
          WHEN v IS NOT NULL THEN 'new' WHEN w = 'hundred' AND open AND low BETWEEN 1 AND 9 THEN 'hundred' WHEN w = 'thousand' AND open AND high = 0 AND low BETWEEN 1 AND 999 THEN 'thousand' ELSE 'word' END AS kind,
          CASE WHEN open THEN o || ' ' || (high + low) ELSE o END AS flushed
        FROM (SELECT step.*, words.ws[step.k + 1] AS w, num.m[words.ws[step.k + 1]] AS v FROM step JOIN words USING ({ids}), num WHERE step.k < len(words.ws)))),
    done AS (SELECT {ids}, CASE WHEN t = '' THEN '' ELSE substr(CASE WHEN open THEN o || ' ' || (high + low) ELSE o END, 2) END AS normal FROM step JOIN words USING ({ids}) WHERE k = len(ws))
    SELECT {ids}, normal FROM source LEFT JOIN done USING ({ids})"""


@query("normalize", normal_sql("SELECT conv_id, turn, text FROM conversations", "conv_id, turn"))
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.normalize(F.col("text")).alias("normal"))


#: Number words and contractions in a text of every event, so that each rule of the normaliser is met.
_TENS, _UNITS = (", ".join(f"'{w}'" for w in ws) for ws in (text.TENS, text.UNITS))
SPOKEN_SQL = f"""SELECT event_id, 'What' || chr(39) || 's ' || ([{_TENS}])[event_id % 8 + 1] || ' ' || ([{_UNITS}])[event_id % 20 + 1] || ' ' || (['hundred', 'thousand', 'and', 'zero'])[event_id % 4 + 1]
    || ' ' || ([{_UNITS}])[CAST(floor(event_id / 7) AS BIGINT) % 20 + 1] || ' I' || chr(39) || 'm ' || event_type || ' !' AS text FROM events"""


def spoken() -> Column:
    tens, units = (F.array(*map(F.lit, ws)) for ws in (text.TENS, text.UNITS))
    ends = F.array(*map(F.lit, ("hundred", "thousand", "and", "zero")))
    pick = lambda a, n: F.get(a, (n % F.size(a)).cast("int"))
    k = F.col("event_id")
    return F.concat_ws(" ", F.lit("What's"), pick(tens, k), pick(units, k), pick(ends, k), pick(units, F.floor(k / 7)), F.lit("I'm"), "event_type", F.lit("!"))


@query("number_words", normal_sql(SPOKEN_SQL, "event_id"))
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", text.normalize(spoken()).alias("normal"))


@query(
    "render_schema",
    r"""SELECT event_id, '{k:' || CAST(props->>'k' AS VARCHAR) || '}' AS rendered, '{"k": ' || CAST(props->>'k' AS VARCHAR) || '}' AS canonical,
      '{type:<escape>OBJECT<escape>,properties:{' || event_type || ':{type:<escape>STRING<escape>,n:' || user_id || ',x:[1.5,true,<escape>NULL<escape>,<escape>A"B, {:}<escape>]}},required:[<escape>' || upper(event_type) || '<escape>]}' AS nested,
      '{"properties": {"' || event_type || '": {"n": ' || user_id || ', "type": "string", "x": [1.5, true, null, "a\"b, {:}"]}}, "required": ["' || event_type || '"], "type": "object"}' AS sorted FROM events""",
)
def _(spark, sf):
    nested = F.concat(F.lit('{"type": "object", "properties": {"'), "event_type", F.lit('": {"type": "string", "n": '), "user_id", F.lit(r', "x": [1.5, true, null, "a\"b, {:}"]}}, "required": ["'), "event_type", F.lit('"]}'))
    events = table(spark, sf, "events").withColumn("nested", nested)
    return events.select("event_id", jsontext.render_schema(F.col("props")).alias("rendered"), jsontext.canonical_json("props").alias("canonical"), jsontext.render_schema(F.col("nested")).alias("nested"), jsontext.canonical_json("nested").alias("sorted"))


@query(
    "keyword_drop",
    """SELECT source, count(*) AS total, count_if(h) AS dropped, round(CAST(count_if(h) * 100.0 / count(*) AS DOUBLE), 6) AS percent, count_if(h) = count(*) AS emptied
    FROM (SELECT source, contains(lower(text), 'license') AS h FROM documents) GROUP BY source""",
)
def _(spark, sf):
    hit = text.keyword_hit(F.col("text"), anywhere=["license"])
    return decontam.drop_keyword_hits(table(spark, sf, "documents").select("source", "text"), hit, "source")[1]


@query("siblings", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey <> 7")
def _(spark, sf):
    return catalog.siblings(table(spark, sf, "nation").select("n_nationkey", "n_name"), 7, "n_nationkey")


@query("max_length", "SELECT CAST(least(max(length(text)) + 100, 2048) AS BIGINT) AS max_length FROM (SELECT text FROM benchmark ORDER BY item_id LIMIT 500)")
def _(spark, sf):
    return assemble.max_length(table(spark, sf, "benchmark"), F.length("text"), "item_id")


@query("single_publish", "SELECT p_partkey, upper(sha256(p_name)) AS sha256 FROM part WHERE p_partkey % 4 = 0 OR p_partkey % 6 <> 0")
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.upper(F.sha2("p_name", 256)).alias("sha256"))
    old = parts.where("p_partkey % 6 = 0").withColumn("sha256", F.when(F.col("p_partkey") % 4 == 0, "other").otherwise(F.lower("sha256")))
    return publish.publish_single(parts, old, "p_partkey")


@query(
    "manifest_versions",
    """SELECT p_brand, '2026.01.02-' || left(sha256(string_agg(name || ':' || sha || ',', '' ORDER BY name)), 7) AS version, '2026-01-02T03:04:05Z' AS released_at,
      string_agg(name || ' ' || 'u/' || name || ' ' || sha || ' ' || size, chr(10) ORDER BY name) AS files FROM (SELECT p_brand, CAST(p_partkey AS VARCHAR) AS name, sha256(p_name) AS sha, strlen(p_name) AS size FROM part) GROUP BY p_brand""",
)
def _(spark, sf):
    name = F.col("p_partkey").cast("string")
    files = table(spark, sf, "part").select("p_brand", name.alias("name"), F.concat(F.lit("u/"), name).alias("url"), F.sha2("p_name", 256).alias("sha256"), F.octet_length("p_name").cast("long").alias("size_bytes"))
    m = publish.manifest(files, "p_brand", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    lines = F.transform("files", lambda f: F.concat_ws(" ", f["name"], f["url"], f["sha256"], f["size_bytes"].cast("string")))
    return m.select("p_brand", "version", "released_at", F.array_join(lines, "\n").alias("files"))


@query("wake_counters", "SELECT event_id, user_id + event_id AS ticks FROM events")
def _(spark, sf):
    from ..sources.text_files import cpu_ticks

    rest = [F.lit("0")] * 10 + [F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.lit("0")]
    line = F.concat_ws(" ", F.lit("7 (a b) c) S"), *rest)
    return cpu_ticks(table(spark, sf, "events").withColumn("stat", line)).select("event_id", "ticks")
