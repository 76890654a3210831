"""Queries of sources, sinks and small operators: files' texts are made from the driver's tables and go through the parsers that read files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext, text
from ..operators import ab, assemble, catalog, decontam, expand, metrics, ordering, publish
from ..sources import sinks, text_files
from .queries import SPACE, fingerprints, frames, inline, key_sql, prints, query, slots, table, verdicts
from .queries import EXPAND_SQL, VERDICTS

# Banks: a file for each brand, with a skill for each of its types; frames are the names of its parts.


def bank_files(spark, sf) -> DataFrame:
    parts = table(spark, sf, "part").withColumn("skill", F.concat_ws(".", "p_brand", "p_type"))
    args = F.when(F.col("p_partkey") % 3 != 0, F.create_map(F.lit("size"), F.lit("{SIZE}")))
    one = F.struct("p_partkey", F.concat("p_name", F.lit(" of {SIZE}")).alias("text"), args.alias("args"))
    skills = parts.groupBy("p_brand", "skill").agg(F.array_sort(F.collect_list(F.col("p_partkey"))).alias("k"), F.collect_list(one).alias("f"))
    listed = F.transform(F.array_sort("f", lambda a, b: (a["p_partkey"] - b["p_partkey"]).cast("int")), lambda x: F.struct(x["text"].alias("text"), x["args"].alias("args")))
    bank = F.struct(F.when(F.size("f") > 3, F.size("f")).alias("target"), F.lit(None).cast("int").alias("cap"), listed.alias("frames"))
    files = skills.groupBy("p_brand").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("skill", bank)))).alias("value"))
    files = files.select(F.concat(F.lit("frames."), "p_brand", F.lit(".en.json")).alias("file_name"), "value")
    return files.unionByName(files.select(F.concat(F.lit("draft-"), "file_name").alias("file_name"), "value"))


BANKS = """b AS (SELECT p_brand || '.' || p_type AS skill_id, 'frames.' || p_brand || '.en.json' AS src_file, p_name || ' of {SIZE}' AS text, CASE WHEN p_partkey % 3 <> 0 THEN '{SIZE}' END AS size,
    row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1 AS frame_ord, count(*) OVER (PARTITION BY p_brand, p_type) AS n FROM part)"""


@query("bank_frames", f"WITH {BANKS} SELECT 'en' AS locale, skill_id, CASE WHEN n > 3 THEN n ELSE 500 END AS target, 12 AS cap, frame_ord, text, size, src_file FROM b")
def _(spark, sf):
    entries = text_files.bank_entries(bank_files(spark, sf), text_files.FRAME_BANK)
    return text_files.frames_of(entries, "en").withColumn("size", F.col("args")["size"]).drop("args")


@query("banked_ids", f"WITH {BANKS} SELECT DISTINCT skill_id FROM b")
def _(spark, sf):
    return text_files.banked_ids(text_files.bank_entries(bank_files(spark, sf), text_files.FRAME_BANK))


@query("bank_texts", f"WITH {BANKS} SELECT skill_id, text FROM b UNION ALL SELECT p_brand, p_name FROM part")
def _(spark, sf):
    entries = text_files.bank_entries(bank_files(spark, sf), text_files.FRAME_BANK)
    examples = table(spark, sf, "part").select(F.col("p_brand").alias("skill_id"), F.col("p_name").alias("text"))
    return text_files.bank_texts(text_files.frames_of(entries, "en"), examples)


@query(
    "bank_slots",
    """SELECT 'NATION' || n_regionkey AS slot, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS val_ord, lower(n_name) AS surface, n_name AS canonical FROM nation
    UNION ALL SELECT 'RANGE' || r_regionkey, v, CAST(v + r_regionkey AS VARCHAR), CAST(v + r_regionkey AS VARCHAR) FROM region, range(0, 5) t(v)""",
)
def _(spark, sf):
    one = F.struct("n_nationkey", F.lower("n_name").alias("surface"), F.col("n_name").alias("canonical"))
    listed = table(spark, sf, "nation").groupBy(F.concat(F.lit("NATION"), "n_regionkey").alias("slot")).agg(F.to_json(F.array_sort(F.collect_list(one))).alias("json"))
    low = F.col("r_regionkey")
    ranged = table(spark, sf, "region").select(F.concat(F.lit("RANGE"), low).alias("slot"), F.to_json(F.struct(F.lit("int").alias("type"), low.alias("min"), (low + 4).alias("max"))).alias("json"))
    value = F.concat(F.lit('{"'), "slot", F.lit('": '), "json", F.lit("}"))
    files = listed.unionByName(ranged).select(F.concat(F.lit("slots."), "slot", F.lit(".en.json")).alias("file_name"), value.alias("value"))
    return text_files.slots_of(text_files.bank_entries(files, text_files.SLOT_BANK))


# Evaluation cases: a line for each turn, with comments and blank lines between.


def case_lines(spark, sf) -> DataFrame:
    turns = table(spark, sf, "conversations")
    label = F.when(F.col("role") == "system", F.when(F.col("turn") % 2 == 0, "NONE").otherwise("none")).otherwise(F.col("role"))
    own = F.to_json(F.struct(F.col("text").alias("utterance"), label.alias("expect")))
    lines = F.array(F.concat(F.lit("// turn "), "turn"), F.lit("   "), F.concat(F.lit("  "), own))
    return turns.select(F.concat(F.lit("f"), F.col("conv_id") % 3).alias("file"), F.explode(lines).alias("value"))


CASES = "c AS (SELECT 'f' || conv_id % 3 AS file, text AS utterance, CASE WHEN role = 'system' THEN CASE WHEN turn % 2 = 0 THEN 'NONE' ELSE 'none' END ELSE role END AS expect FROM conversations)"


@query("eval_cases", f"WITH {CASES} SELECT * FROM c")
def _(spark, sf):
    return text_files.cases_of(case_lines(spark, sf))


@query("eval_keys", f"WITH {CASES} SELECT DISTINCT {key_sql('utterance')} AS key FROM c")
def _(spark, sf):
    return text_files.eval_keys(text_files.cases_of(case_lines(spark, sf)))


@query("spine_none", f"WITH {CASES} SELECT file, utterance FROM c WHERE upper(expect) = 'NONE'")
def _(spark, sf):
    return text_files.none_cases(text_files.cases_of(case_lines(spark, sf))).select("file", "utterance")


@query(
    "eval_file",
    f"""WITH {CASES}, o AS (SELECT utterance, expect, min(conv_id * 100 + turn) AS ord FROM (SELECT c.*, conv_id, turn FROM c POSITIONAL JOIN conversations) GROUP BY utterance, expect),
    l AS (SELECT CASE WHEN upper(expect) = 'NONE' THEN 1 ELSE 0 END AS part, expect, ord, '{{"utterance":' || to_json(utterance) || ',"expect":' || to_json(expect) || '}}' AS value FROM o UNION ALL SELECT -1, '', k, ['// made by hand', '// keep the order'][k + 1] FROM range(0, 2) t(k))
    SELECT CAST(row_number() OVER (ORDER BY part, expect, ord, value) AS INTEGER) AS line, value FROM l""",
)
def _(spark, sf):
    turns = table(spark, sf, "conversations")
    label = F.when(F.col("role") == "system", F.when(F.col("turn") % 2 == 0, "NONE").otherwise("none")).otherwise(F.col("role"))
    cases = turns.groupBy(F.col("text").alias("utterance"), label.alias("expect")).agg(F.min(F.col("conv_id") * 100 + F.col("turn")).alias("ord"))
    return sinks.numbered_eval_lines(cases, ["made by hand", "keep the order"])


# Logs of verdicts: a line for each event, the threshold's stated twice.


def log_lines(spark, sf) -> DataFrame:
    pick = F.when(F.col("event_id") % 5 == 0, "NONE").when(F.col("event_id") % 7 == 0, "None").otherwise(F.col("event_type"))
    conf = F.when(F.col("event_id") % 11 == 0, "NaN").otherwise((-F.col("value")).cast("string"))
    verdict = F.concat_ws("\t", F.lit("VERBOSE"), "event_type", conf, F.lit("view"), pick, F.concat(F.lit("say\t"), "event_id"))
    stated = F.concat(F.lit("threshold:  MIN_ROUTER_CONFIDENCE = -0."), "event_id")
    lines = F.array(F.lit("noise"), verdict, F.when(F.col("event_id") % 100 == 0, stated).otherwise(""))
    return table(spark, sf, "events").select(F.posexplode(lines).alias("k", "value"), "event_id").select(F.struct("event_id", "k").alias("place"), "value")


@query(
    "verdict_log",
    """SELECT event_type AS category, CASE WHEN event_id % 5 <> 0 AND event_id % 11 <> 0 THEN -value END AS conf, 'view' AS expect,
      CASE WHEN event_id % 5 <> 0 AND event_id % 11 <> 0 THEN CASE WHEN event_id % 7 = 0 THEN 'None' ELSE event_type END END AS pick, 'say' || chr(9) || event_id AS utterance FROM events""",
)
def _(spark, sf):
    return text_files.verdict_cases(log_lines(spark, sf))


@query("log_threshold", "SELECT CAST('-0.' || max(event_id) AS DOUBLE) AS threshold FROM events WHERE event_id % 100 = 0")
def _(spark, sf):
    return text_files.last_threshold(log_lines(spark, sf))


# Manifests with front matter: a folder for each nation. Some lack the Italian or the English file, some have a broken one.


def manifest_files(spark, sf) -> DataFrame:
    k = F.col("n_nationkey")

    def manifest(locale: str, broken: Column) -> Column:
        head = F.concat(
            F.lit("---\ndescription: A skill\n  of "), "n_name", F.lit(" # note\nmetadata:\n  skill:\n    id: dev."), F.lower(F.translate("n_name", " ", "_")),
            F.when(k % 6 == 5, F.lit("\n    type: assistant")).otherwise(F.lit("")),
            F.lit(f"\n    examples:\n      - text: \"go to {locale} "), "n_name", F.lit("\"\n        args: {place: '"), "n_name", F.lit("', n: 3}\n      - {text: ' '}\n      - {text: ''}\n---\nbody\n---\n"),
        )
        return F.when(broken, F.concat(F.lit("---\na: [b\n---\n"), "n_name")).otherwise(head)

    files = F.array(
        F.struct(F.when(k % 2 == 0, "SKILL.it.md").alias("file_name"), manifest("it", k % 4 == 2).alias("value")),
        F.struct(F.when(k % 3 != 0, "SKILL.en.md").alias("file_name"), manifest("en", F.lit(False)).alias("value")),
        F.struct(F.lit("SKILL.md").alias("file_name"), manifest("plain", k == 9).alias("value")),
        F.struct(F.lit("README.md").alias("file_name"), F.lit("no head").alias("value")),
    )
    return table(spark, sf, "nation").withColumn("f", F.explode(files)).select(F.concat(F.lit("skills/"), k).alias("dir"), "f.*").where("file_name IS NOT NULL")


CHOSEN = """m AS (SELECT n_nationkey AS k, n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'it' WHEN n_nationkey % 3 <> 0 THEN 'en' ELSE 'plain' END AS way FROM nation),
    good AS (SELECT *, 'dev.' || lower(replace(n_name, ' ', '_')) AS id FROM m WHERE NOT (way = 'it' AND k % 4 = 2) AND NOT (way = 'plain' AND k = 9))"""


@query(
    "front_matter",
    """WITH f AS (SELECT n_nationkey AS k, n_name, unnest(['it', 'en', 'plain', 'readme']) AS way FROM nation)
    SELECT 'skills/' || k AS dir, CASE way WHEN 'plain' THEN 'SKILL.md' WHEN 'readme' THEN 'README.md' ELSE 'SKILL.' || way || '.md' END AS file_name,
      CASE WHEN way = 'readme' OR (way = 'it' AND k % 4 = 2) OR (way = 'plain' AND k = 9) THEN NULL ELSE 'A skill of ' || n_name END AS description
    FROM f WHERE (way <> 'it' OR k % 2 = 0) AND (way <> 'en' OR k % 3 <> 0)""",
)
def _(spark, sf):
    return text_files.heads_of(manifest_files(spark, sf)).select("dir", "file_name", F.get_json_object("head", "$.description").alias("description"))


@query(
    "community_skills",
    f"""WITH {CHOSEN} SELECT 'skills/' || k AS dir, id, 'A skill of ' || n_name AS description, 'go to ' || way || ' ' || n_name || '| ' AS texts, n_name AS place, '3' AS n FROM good WHERE k % 6 <> 5""",
)
def _(spark, sf):
    skills = text_files.skills_of(text_files.heads_of(manifest_files(spark, sf)), "it")
    args = F.col("examples")[0]["args"]
    return skills.select("dir", "id", "description", F.array_join(F.transform("examples", lambda e: e["text"]), "|").alias("texts"), args["place"].alias("place"), args["n"].alias("n"))


@query(
    "declared_id",
    """WITH f AS (SELECT n_nationkey AS k, lower(n_name) AS id, unnest(['it', 'en', 'plain']) AS way FROM nation)
    SELECT 'skills/' || k AS dir, CASE way WHEN 'plain' THEN 'SKILL.md' ELSE 'SKILL.' || way || '.md' END AS file_name FROM f
    WHERE id = 'nation_4' AND NOT (way = 'it' AND k % 4 = 2) AND NOT (way = 'plain' AND k = 9) AND (way <> 'it' OR k % 2 = 0) AND (way <> 'en' OR k % 3 <> 0)""",
)
def _(spark, sf):
    return manifest_files(spark, sf).where(text.declares_id(F.col("value"), "dev.nation_4")).select("dir", "file_name")


# Exports, ledgers, samples, sidecars, listings, manifests.


@query(
    "builtin_skills",
    """SELECT 'r' || n_regionkey || '.' || n_nationkey AS id, n_name AS description, '{"type":"object"}' AS parameters, n_nationkey % 3 <> 1 AS router_eligible, n_name AS text FROM nation""",
)
def _(spark, sf):
    k = F.col("n_nationkey")
    skill = F.struct(
        F.concat(F.lit("r"), "n_regionkey", F.lit("."), k).alias("id"), F.col("n_name").alias("description"), F.struct(F.lit("object").alias("type")).alias("parameters"),
        F.when(k % 3 != 0, k % 3 == 2).alias("router_eligible"), F.array(F.struct(F.col("n_name").alias("text"), F.create_map(F.lit("k"), k.cast("string")).alias("args"))).alias("examples"),
    )
    files = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.to_json(F.collect_list(skill)).alias("value"))
    return text_files.exported_skills(files).select("id", "description", "parameters", "router_eligible", F.col("examples")[0]["text"].alias("text"))


@query("ledger_scan", "SELECT 'b' || p_brand AS skill_id, 'l' || p_size AS locale, sha256(min(p_name)) AS sha256 FROM part GROUP BY p_brand, p_size")
def _(spark, sf):
    each = table(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.sha2(F.min("p_name"), 256).alias("sha"))
    inner = each.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("l"), "p_size"), "sha"))).alias("m"))
    files = inner.select(F.to_json(F.create_map(F.concat(F.lit("b"), "p_brand"), F.col("m"))).alias("value"))
    return text_files.ledger_of(files)


SAMPLE = "metadata string, conv_id bigint, messages array<struct<role:string,content:string>>"


def sample_rows(spark, sf) -> DataFrame:
    message = F.struct("role", F.col("text").alias("content"))
    return table(spark, sf, "conversations").select(F.when(F.col("conv_id") % 10 == 0, "eval").otherwise("train").alias("metadata"), "conv_id", "turn", F.array(message).alias("messages"))


@query("samples_scan", "SELECT conv_id, role, text AS content FROM conversations WHERE conv_id % 10 = 0")
def _(spark, sf):
    lines = sample_rows(spark, sf).select(F.to_json(F.struct("metadata", "conv_id", "messages")).alias("value"))
    return text_files.samples_of(lines, SAMPLE, "eval").select("conv_id", F.col("messages")[0]["role"].alias("role"), F.col("messages")[0]["content"].alias("content"))


@query(
    "sample_lines",
    """SELECT CASE WHEN conv_id % 10 = 0 THEN 1 ELSE 0 END AS part, conv_id, turn,
      '{"metadata":"' || CASE WHEN conv_id % 10 = 0 THEN 'eval' ELSE 'train' END || '","messages":[{"role":' || to_json(role) || ',"content":' || to_json(text) || '}]}' AS value FROM conversations""",
)
def _(spark, sf):
    return sinks.sample_lines(sample_rows(spark, sf), ["conv_id", "turn"])


@query("sidecar_scan", "SELECT 'c' || item_id AS clip, CASE WHEN item_id % 3 <> 0 THEN trim(string_split(text, chr(10))[1], ' ') END AS device FROM benchmark")
def _(spark, sf):
    lines = F.concat(F.lit("device: x\n"), F.when(F.col("item_id") % 3 != 0, F.concat(F.lit("transcript: "), "text", F.lit("\ntranscript: no\n"))).otherwise(F.lit("")))
    return text_files.sidecars_of(table(spark, sf, "benchmark").select(F.concat(F.lit("c"), "item_id", F.lit(".txt")).alias("file_name"), lines.alias("value")))


@query(
    "first_present",
    """SELECT p_brand, arg_min(name, rank) AS name FROM (SELECT p_brand, p_type AS name, list_position(['PROMO', 'SMALL', 'LARGE', 'MEDIUM'], p_type) AS rank FROM part) WHERE rank > 0 GROUP BY p_brand""",
)
def _(spark, sf):
    return text_files.first_present(table(spark, sf, "part").select("p_brand", F.col("p_type").alias("name")), "p_brand", "name", ["PROMO", "SMALL", "LARGE", "MEDIUM"])


@query(
    "file_meta",
    """SELECT p_partkey AS name, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 <> 0 THEN p_brand ELSE sha256(p_name) END AS sha256,
      CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 <> 0 THEN p_size ELSE strlen(p_name) END AS size_bytes FROM part""",
)
def _(spark, sf):
    k = F.col("p_partkey")
    listing = table(spark, sf, "part").select(k.alias("name"), F.when(k % 3 != 0, F.concat(F.lit('"'), "p_brand", F.lit('"'))).alias("etag"), F.when(k % 4 != 0, F.col("p_size")).alias("linked_size"), F.col("p_name").cast("binary").alias("content"))
    return publish.file_meta(listing)


@query("existing_manifest", "SELECT p_brand AS tag, CAST(p_partkey AS VARCHAR) AS name, sha256(p_name) AS sha256 FROM part WHERE p_brand NOT LIKE '%1' AND p_brand NOT LIKE '%2'")
def _(spark, sf):
    one = F.struct(F.col("p_partkey").cast("string").alias("name"), F.lit("u").alias("url"), F.sha2("p_name", 256).alias("sha256"), F.lit(1).alias("size_bytes"))
    whole = table(spark, sf, "part").groupBy(F.col("p_brand").alias("tag")).agg(F.to_json(F.struct(F.lit("2026.01.02-abcdefg").alias("version"), F.collect_list(one).alias("files"))).alias("v"))
    value = F.when(F.endswith("tag", F.lit("1")), F.lit(None)).when(F.endswith("tag", F.lit("2")), F.substring("v", 1, 40)).otherwise(F.col("v"))
    return publish.released_files(publish.existing_manifest(whole.select("tag", value.alias("value"))))


@query(
    "model_publish",
    """SELECT p_brand, '2026.01.02-' || left(sha256(string_agg(name || ':' || sha || ',', '' ORDER BY name)), 7) AS version, '2026-01-02T03:04:05Z' AS released_at, CAST(-0.06 AS DOUBLE) AS min_confidence
    FROM (SELECT p_brand, CAST(p_partkey AS VARCHAR) AS name, sha256(p_name) AS sha FROM part) GROUP BY p_brand""",
)
def _(spark, sf):
    files = table(spark, sf, "part").select("p_brand", F.col("p_partkey").cast("string").alias("name"), F.lit("u").alias("url"), F.sha2("p_name", 256).alias("sha256"), F.lit(1).cast("long").alias("size_bytes"))
    return publish.manifest(files, "p_brand", F.lit("2026-01-02 03:04:05").cast("timestamp"), F.lit(-0.06)).drop("files")


@query(
    "bank_activation",
    f"""WITH {BANKS} SELECT skill_id, src_file, text FROM b WHERE skill_id <> 'Brand#17.ECONOMY' UNION ALL SELECT 'Brand#17.ECONOMY', 'frames.auto.en.json', n_name FROM nation""",
)
def _(spark, sf):
    bank = text_files.frames_of(text_files.bank_entries(bank_files(spark, sf), text_files.FRAME_BANK), "en").select("skill_id", "src_file", "text")
    draft = table(spark, sf, "nation").select(F.lit("Brand#17.ECONOMY").alias("skill_id"), F.col("n_name").alias("text"))
    return catalog.activate_bank(bank, draft.withColumn("src_file", F.lit("")), "Brand#17.ECONOMY", "frames.auto.en.json")


@query("new_slots", "SELECT n_name AS slot, n_nationkey AS v FROM nation WHERE n_regionkey NOT IN (1, 3)")
def _(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("slot"), F.col("n_nationkey").alias("v"), "n_regionkey")
    return catalog.new_slots(nations.select("slot", "v"), nations.where("n_regionkey IN (1, 3)"))


@query(
    "draft_files",
    """SELECT 'draft-frames.r' || n_regionkey || '.it.json' AS file_name,
      '{"r' || n_regionkey || '":{"target":7,"frames":[' || string_agg('{"text":' || to_json(n_name) || ',"args":{"k":"' || n_nationkey || '"}}', ',' ORDER BY n_nationkey) || ']}}' AS value FROM nation GROUP BY n_regionkey""",
)
def _(spark, sf):
    k = F.col("n_nationkey")
    drafts = table(spark, sf, "nation").select(F.concat(F.lit("r"), "n_regionkey").alias("skill_id"), F.lit(7).alias("target"), F.lit(None).cast("int").alias("cap"), k.alias("frame_ord"), F.col("n_name").alias("text"), F.create_map(F.lit("k"), k.cast("string")).alias("args"))
    return sinks.draft_files(drafts, "it")


# Operators on rows.


@query("banked_skills", f"WITH {BANKS} SELECT p_brand || '.x' || p_size AS skill_id, FALSE AS has_bank FROM part GROUP BY ALL UNION ALL SELECT DISTINCT skill_id, TRUE FROM b")
def _(spark, sf):
    entries = text_files.bank_entries(bank_files(spark, sf), text_files.FRAME_BANK)
    ids = text_files.banked_ids(entries)
    skills = table(spark, sf, "part").select(F.concat("p_brand", F.lit(".x"), "p_size").alias("skill_id")).distinct().unionByName(ids)
    return expand.with_banks(skills, text_files.frames_of(entries, "en"), allow_missing=True)


@query(
    "eval_dropped",
    f"""WITH {EXPAND_SQL}, k AS (SELECT *, {key_sql('text')} AS key, md5('12|' || frame_id || '|' || i) AS o FROM filled),
    f AS (SELECT * FROM k WHERE key NOT LIKE '%asia%' AND NOT (frame_id = 'f5' AND key LIKE '%1%') QUALIFY row_number() OVER (PARTITION BY frame_id, key ORDER BY o, frame_id, i) = 1),
    a AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY frame_id ORDER BY o, frame_id, i) <= 6),
    l AS (SELECT frame_id, max(o) AS last, count(*) AS n FROM a GROUP BY frame_id)
    SELECT k.frame_id, count_if(n IS NULL OR n < 6 OR o <= last) AS eval_dropped FROM k LEFT JOIN l USING (frame_id) WHERE key LIKE '%asia%' AND NOT (k.frame_id = 'f5' AND key LIKE '%1%') GROUP BY k.frame_id""",
)
def _(spark, sf):
    pool = expand.expand_frames(frames(spark), slots(spark, sf), 11, ["frame_id"]).withColumn("key", text.loose_key(F.col("text")))
    seen = pool.where("frame_id = 'f5' AND key LIKE '%1%'").select("frame_id", "key")
    return expand.heldout_dropped(pool, seen, pool.where("key LIKE '%asia%'"), "frame_id", 12, F.lit(6), ["frame_id", "i"])


@query(
    "two_field_templates",
    """SELECT n_name AS thing, CASE WHEN n_regionkey = 2 THEN 'flows' ELSE 'works' END AS verb, t.template, replace(replace(t.template, '{thing}', n_name), '{verb}', CASE WHEN n_regionkey = 2 THEN 'flows' ELSE 'works' END) AS text
    FROM nation, (VALUES ('how {verb} {thing}'), ('explain how {verb} {thing}')) t(template)""",
)
def _(spark, sf):
    things = table(spark, sf, "nation").select(F.col("n_name").alias("thing"), F.when(F.col("n_regionkey") == 2, "flows").otherwise("works").alias("verb"))
    return expand.template_cross(inline(spark, ["('how {verb} {thing}')", "('explain how {verb} {thing}')"], "template"), things)


@query("locale_pool", "SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang FROM documents WHERE lang = 'de'")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return expand.locale_pool(docs, "zz", column="lang").unionByName(expand.locale_pool(docs, "de", column="lang"))


@query("clean_examples", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '' ELSE ' ' END || CASE WHEN turn % 3 = 0 THEN '' ELSE text END AS text FROM conversations WHERE NOT (turn % 2 = 0 AND turn % 3 = 0)")
def _(spark, sf):
    t = F.concat(F.when(F.col("turn") % 2 == 0, "").otherwise(" "), F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("text")))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", t.alias("text"), F.lit(None).cast("map<string,string>").alias("args"))
    return catalog.clean_examples(rows).where("size(args) = 0").select("conv_id", "turn", "text")


@query("distinct_texts", "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(spark, sf):
    return assemble.distinct_texts(table(spark, sf, "documents").select("text", "doc_id"), "text", "doc_id")


@query("positives", "SELECT event_id, event_type AS text, 'tool.' || event_type AS name, json_extract_string(props, '$.k') AS k FROM events WHERE event_type <> 'error'")
def _(spark, sf):
    events = table(spark, sf, "events")
    skills = events.select(F.col("event_type").alias("id")).distinct().where("id <> 'error'").withColumn("alias", F.concat(F.lit("tool."), "id"))
    examples = events.select(F.col("event_type").alias("skill_id"), F.concat_ws("|", "event_id", "event_type").alias("text"), F.from_json("props", "map<string,string>").alias("args"))
    rows = assemble.positives(examples, skills)
    return rows.select(F.substring_index("text", "|", 1).cast("long").alias("event_id"), F.substring_index("text", "|", -1).alias("text"), "name", F.col("args")["k"].alias("k"))


@query(
    "tool_declarations",
    """SELECT string_agg('<start_function_declaration>declaration:' || lower(r_name) || '{description:<escape>' || r_name || '<escape>,parameters:{type:<escape>OBJECT<escape>,n:' || r_regionkey || '}}<end_function_declaration>', '' ORDER BY r_name DESC) AS declarations, count(*) AS tools,
      string_agg(lower(r_name), ',' ORDER BY r_name DESC) AS names FROM region""",
)
def _(spark, sf):
    k = F.col("r_regionkey")
    skills = table(spark, sf, "region").select(F.lower("r_name").alias("alias"), F.col("r_name").alias("description"), F.concat(F.lit('{"type": "object", "n": '), k, F.lit("}")).alias("parameters"), F.rank().over(_by_name()).alias("ord"))
    names = catalog.tools(skills).select(F.array_join(F.transform("tools", lambda t: t["function"]["name"]), ",").alias("names"))
    return jsontext.declarations(skills).join(names, F.lit(True))


def _by_name():
    from pyspark.sql import Window

    return Window.orderBy(F.desc("r_name"))


@query(
    "prompts",
    """SELECT conv_id, '<start_of_turn>developer' || chr(10) || 'Rules' || '<d>' || '<end_of_turn>' || chr(10) || '<start_of_turn>user' || chr(10) || text || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) AS prompt
    FROM conversations WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""",
)
def _(spark, sf):
    first = assemble.first_user_turn(table(spark, sf, "conversations"))
    return first.select("conv_id", jsontext.prompt(F.col("text"), F.lit("<d>"), "Rules").alias("prompt"))


@query("avoid_block", "SELECT source, string_agg('- ' || text, chr(10) ORDER BY doc_id) AS block FROM (SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 15) GROUP BY source")
def _(spark, sf):
    return assemble.bullet_list(table(spark, sf, "documents"), "source", "doc_id", 15)


@query(
    "lenient_calls",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN '__none__' ELSE event_type END AS predicted FROM events""",
)
def _(spark, sf):
    from .queries import calls

    events = table(spark, sf, "events")
    known = events.select(F.col("event_type").alias("name")).distinct()
    return metrics.parse_call(calls(spark, sf), known, hallucination_abstains=True).select("event_id", "predicted")


@query("unknown_labels", "SELECT DISTINCT p_type AS expected FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')")
def _(spark, sf):
    known = inline(spark, ["('PROMO')", "('SMALL')"], "name")
    return metrics.unknown_expected(table(spark, sf, "part").select(F.col("p_type").alias("expected")), known)


@query(
    "latency",
    """SELECT event_type, count(*) AS n, sum(CAST(round_even(value * 1e6, 0) AS BIGINT)) / 1e6 AS total_seconds, sum(CAST(round_even(value * 1e6, 0) AS BIGINT)) / 1e6 / count(*) AS mean_seconds FROM events GROUP BY event_type""",
)
def _(spark, sf):
    return metrics.latency(table(spark, sf, "events"), "value", "event_type")


@query("max_width", "SELECT max(length(p_name)) AS width FROM part")
def _(spark, sf):
    return metrics.max_width(table(spark, sf, "part"), "p_name")


@query(
    "gate_report",
    f"""WITH {VERDICTS}, m AS (SELECT source, count_if(expect <> 'NONE' AND pick IS NOT NULL AND conf >= -0.1) AS fired, count_if(expect <> 'NONE' AND pick = expect AND conf >= -0.1) AS correct,
      count_if(expect = 'NONE' AND NOT (pick IS NOT NULL AND conf >= -0.1)) AS ok, count_if(expect = 'NONE') AS quiet, count_if(expect <> 'NONE') AS pos FROM v GROUP BY source)
    SELECT 'gate: precision ' || CAST(round_even(100 * correct / fired, 0) AS INT) || '%, abstention ' || CAST(round_even(100 * ok / quiet, 0) AS INT) || '%, recall ' || CAST(round_even(100 * correct / pos, 0) AS INT) || '%, ' || fired || ' of ' || pos || ' fired' AS line FROM m""",
)
def _(spark, sf):
    return metrics.report(metrics.gate_metrics(verdicts(spark, sf), -0.1, ["source"]), "gate")


@query(
    "two_round_stats",
    """SELECT source, count(*) AS raw, count_if(quality = 1) AS kept FROM (SELECT source, quality FROM documents JOIN labels USING (doc_id) UNION ALL SELECT source, 0 FROM documents) GROUP BY source""",
)
def _(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    first = docs.join(labels, "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("quality") == 1).alias("kept"))
    second = docs.groupBy("source").agg(F.count(F.lit(1)).alias("raw"), F.lit(0).cast("long").alias("kept"))
    return decontam.add_stats([first, second], "source")


@query("newline_guard", "SELECT n_nationkey, n_name FROM nation")
def _(spark, sf):
    return decontam.newline_guard(table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_name")


@query("decode_variants", "SELECT 'm' AS model, item_id AS clip, v AS variant, CASE v WHEN 'bare' THEN text ELSE text || '.' END AS transcript FROM benchmark, (VALUES ('bare'), ('pad')) t(v) WHERE CASE v WHEN 'bare' THEN text ELSE text || '.' END <> trim(text, '.')")
def _(spark, sf):
    b = table(spark, sf, "benchmark")
    rows = [b.select(F.lit("m").alias("model"), F.col("item_id").alias("clip"), F.lit(v).alias("variant"), t.alias("transcript")) for v, t in (("base", F.btrim("text", F.lit("."))), ("bare", F.col("text")), ("pad", F.concat("text", F.lit("."))))]
    return ab.variant_diff(rows[0].unionByName(rows[1]).unionByName(rows[2]), "base")


@query(
    "small_texts",
    """SELECT n_nationkey, n_name || ' x' AS fenced, n_name AS etag, least(5 * power(2, n_nationkey % 6), 60) AS wait, CAST(round_even(100.0 * n_nationkey / 8, 0) AS INT) || '%' AS share, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS called FROM nation""",
)
def _(spark, sf):
    k = F.col("n_nationkey")
    fence = F.concat(F.lit("```json\n"), "n_name", F.lit(" x\n```"))
    raw = F.when(k % 2 == 0, F.concat(F.lit("<start_function_call>call:"), "n_name", F.lit("{}"))).otherwise("none")
    return table(spark, sf, "nation").select("n_nationkey", text.strip_fences(fence).alias("fenced"), text.unquote(F.concat(F.lit('"'), "n_name", F.lit('"'))).alias("etag"), text.backoff(k % 6).cast("double").alias("wait"), text.percent(k / 8).alias("share"), text.first_call(raw).alias("called"))


@query(
    "ci_outputs",
    """WITH b AS (SELECT p_brand, count(*) AS n, min(p_name) AS first FROM part GROUP BY p_brand)
    SELECT p_brand, unnest([0, 1]) AS k, unnest(['files=' || n, 'first=' || first]) AS value FROM b""",
)
def _(spark, sf):
    brands = table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.min("p_name").alias("first"))
    lines = sinks.key_value_lines(brands.select(F.concat_ws("|", "n", "p_brand").alias("files"), F.concat_ws("|", "first", "p_brand").alias("first")))
    return lines.select(F.element_at(F.split("value", "[|]"), -1).alias("p_brand"), "k", F.substring_index("value", "|", 1).alias("value"))


@query("wav_samples", "SELECT event_id, CAST((event_id * 37 % 65536 - 32768) / 32768.0 AS DOUBLE) AS sample FROM events")
def _(spark, sf):
    from ..sources.audio import wav_samples

    # a mono clip of 16 bits at 16 kHz with one sample, low byte first
    head = (b"RIFF" + (38).to_bytes(4, "little") + b"WAVEfmt " + (16).to_bytes(4, "little") + b"\1\0\1\0" + (16_000).to_bytes(4, "little") + (32_000).to_bytes(4, "little") + b"\2\0\x10\0data" + (2).to_bytes(4, "little")).hex()
    unsigned = (F.col("event_id") * 37 + 32_768) % 65_536
    byte = lambda x: F.lpad(F.hex(x), 2, "0")
    content = F.unhex(F.concat(F.lit(head), byte(unsigned % 256), byte(F.floor(unsigned / 256))))
    return table(spark, sf, "events").select("event_id", wav_samples(content)[0].cast("double").alias("sample"))


@query(
    "dataset",
    f"""WITH pos AS (SELECT event_id AS ord, 'p' || event_id AS text, event_type AS name FROM events WHERE event_type = 'error'), n AS (SELECT CAST(round_even(count(*) * CAST(0.5 AS DOUBLE), 0) AS BIGINT) AS n, count(*) AS p FROM pos),
    neg AS (SELECT text FROM (SELECT DISTINCT text FROM documents WHERE {key_sql('text')} NOT IN (SELECT {key_sql('text')} FROM documents WHERE doc_id % 17 = 0)) ORDER BY md5('4|' || text), text LIMIT (SELECT n FROM n)),
    every AS (SELECT text, name, ord FROM pos UNION ALL SELECT text, NULL, -1 FROM neg)
    SELECT CASE WHEN row_number() OVER (ORDER BY md5('4|' || CASE WHEN name IS NULL THEN '' ELSE name || '|' END || ord || '|' || text), text) <= floor((SELECT count(*) FROM every) * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'eval' END AS metadata, text, name FROM every""",
)
def _(spark, sf):
    events, docs = table(spark, sf, "events"), table(spark, sf, "documents")
    pos = events.where("event_type = 'error'").select(F.concat(F.lit("p"), "event_id").alias("text"), F.col("event_type").alias("name"), F.create_map().cast("map<string,string>").alias("args"), F.col("event_id").alias("ord"))
    heldout = docs.where("doc_id % 17 = 0").select(text.loose_key(F.col("text")).alias("key"))
    return assemble.dataset(pos, docs.select("text", F.col("doc_id").alias("ord")), heldout, 0.5, 4).select("metadata", "text", "name")
