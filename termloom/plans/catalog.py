"""The queries of the engine's own operators, with SQL that gives the same rows.

The test tables hold no bilingual files, so pairs are conversation turns, files
are documents, and their lines are sentences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import morph, names, text
from termloom.functions.anchor import anchor
from termloom.operators import answers, dedup, delivery, lexicon, metrics, planning, verify
from termloom.operators.provider import Price, RuleProvider, cost, worklist
from termloom.plans.run import corrected, offline, plan
from termloom.sources import corpus

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return corpus.conversation_pairs(_read(spark, d, "conversations"))


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select(F.col("conv_id").cast("string").alias("file"), (F.col("turn") + 1).cast("int").alias("pos"), "src", "tgt")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("file"), F.concat_ws("/", "lang", "source").alias("layer"), F.posexplode(F.split("text", "\n", -1)).alias("p", "src"))
    return docs.select("file", "layer", (F.col("p") + 1).alias("pos"), "src", F.col("src").alias("tgt")).where(text.is_meaningful("src"))


PAIRS = """pairs AS (SELECT conv_id, turn, text AS src, next_text AS tgt FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')"""
SENTENCES = PAIRS + r""", sentences AS (SELECT CAST(conv_id AS VARCHAR) AS file, CAST(turn + 1 AS INT) AS pos, src, tgt FROM pairs WHERE regexp_matches(src, '\p{L}') AND regexp_matches(tgt, '\p{L}'))"""
LINES = r"""lines AS (SELECT CAST(doc_id AS VARCHAR) AS file, lang || '/' || source AS layer, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos, unnest(string_split(text, chr(10))) AS src FROM documents), good AS (SELECT * FROM lines WHERE regexp_matches(src, '\p{L}'))"""
TOKENS = r"""w AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(text, '[ \n\t\r]+'), lambda x: x <> '') AS ws FROM documents WHERE lang IN ('es', 'fr')), tok AS (SELECT doc_id, lang, i, regexp_replace(ws[i], '^[.,;:!?]+|[.,;:!?]+$', '', 'g') AS base, regexp_replace(ws[i + 1], '^[.,;:!?]+|[.,;:!?]+$', '', 'g') AS span FROM w, unnest(range(1, len(ws))) AS r(i))"""


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents").where(F.col("lang").isin("es", "fr"))
    # split leaves an empty word at either end at most; signs are trimmed, which costs a fraction of a regular expression
    ws = docs.select("doc_id", "lang", F.array_remove(F.split("text", r"[ \n\t\r]+"), "").alias("ws"))
    n = F.greatest(F.size("ws") - 1, F.lit(0))
    rows = ws.select("doc_id", "lang", F.posexplode(F.arrays_zip(F.slice("ws", 1, n).alias("w"), F.slice("ws", 2, n).alias("next"))).alias("p", "pair"))
    bare = lambda c: F.btrim(c, F.lit(".,;:!?"))
    return rows.select("doc_id", "lang", (F.col("p") + 1).cast("long").alias("i"), bare(F.col("pair.w")).alias("base"), bare(F.col("pair.next")).alias("span"))


@query(f"WITH {PAIRS} SELECT * FROM pairs")
def pair_scan(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)


@query(f"WITH {SENTENCES} SELECT * FROM sentences")
def usable_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _sentences(spark, d).where(text.usable("src", "tgt"))


@query(r"""WITH t AS (SELECT lang, CASE WHEN doc_id % 3 = 0 THEN repeat('汉字', CAST(doc_id % 7 AS INT)) || text ELSE text END AS s FROM documents), r AS (SELECT lang, CASE WHEN length(regexp_replace(s, '[ \t\n\r]', '', 'g')) > 0 THEN length(regexp_replace(s, '[^一-鿿]', '', 'g')) / length(regexp_replace(s, '[ \t\n\r]', '', 'g')) ELSE 0 END AS ratio FROM t) SELECT lang, count(*) AS n, count(*) FILTER (ratio > 0.3) AS n_chinese, round(sum(ratio), 6) AS total FROM r GROUP BY lang""")
def cjk_ratio_stats(spark: SparkSession, d: str) -> DataFrame:
    own = F.when(F.col("doc_id") % 3 == 0, F.concat(F.repeat(F.lit("汉字"), (F.col("doc_id") % 7).cast("int")), F.col("text"))).otherwise(F.col("text"))
    rows = _read(spark, d, "documents").select("lang", text.cjk_ratio(own).alias("ratio"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ratio") > names.CHINESE).alias("n_chinese"), F.round(F.sum("ratio"), 6).alias("total"))


@query(f"WITH {PAIRS}, t AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN '汉字' || src ELSE src END AS src, CASE WHEN conv_id % 2 = 0 THEN '汉' || tgt ELSE tgt END AS tgt FROM pairs), r AS (SELECT conv_id, turn, " + ", ".join(rf"coalesce(length(regexp_replace({s}, '[^一-鿿]', '', 'g')) / nullif(length(regexp_replace({s}, '[ \t\n\r]', '', 'g')), 0), 0) AS {s}" for s in ("src", "tgt")) + " FROM t) SELECT conv_id, turn, CASE WHEN src >= tgt THEN 'tgt' ELSE 'src' END AS side FROM r")
def foreign_side_pairs(spark: SparkSession, d: str) -> DataFrame:
    src = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("汉字"), "src")).otherwise(F.col("src"))
    tgt = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("汉"), "tgt")).otherwise(F.col("tgt"))
    return _pairs(spark, d).select("conv_id", "turn", text.foreign_side(src, tgt).alias("side"))


@query(f"WITH {LINES} SELECT layer, count(DISTINCT file) AS files, count(*) AS sentences FROM good GROUP BY layer")
def layer_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.layer_stats(_lines(spark, d))


@query("SELECT doc_id, digest, representative, copies FROM (SELECT doc_id, md5(text) AS digest, min(doc_id) OVER (PARTITION BY md5(text)) AS representative, count(*) OVER (PARTITION BY md5(text)) AS copies FROM documents)")
def content_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.content_dedup(_read(spark, d, "documents"), F.md5("text"), "doc_id").select("doc_id", "digest", "representative", "copies")


@query("WITH reps AS (SELECT md5(text) AS digest, min(doc_id) AS representative, length(min_by(text, doc_id)) AS chars FROM documents GROUP BY 1) SELECT doc_id, digest, representative, chars FROM (SELECT doc_id, md5(text) AS digest FROM documents) JOIN reps USING (digest)")
def dup_fanout(spark: SparkSession, d: str) -> DataFrame:
    files = dedup.content_dedup(_read(spark, d, "documents"), F.md5("text"), "doc_id")
    made = files.where("doc_id = representative").select("digest", "representative", F.length("text").cast("long").alias("chars"))
    return dedup.fan_out(made, files.select("doc_id", "digest")).select("doc_id", "digest", "representative", "chars")


NAMED = "named AS (SELECT doc_id, source AS container, lang || '-' || (n_chars % 97) AS basename FROM documents), sizes AS (SELECT container, count(*) AS entries FROM named GROUP BY 1)"


def _named(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "documents").select("doc_id", F.col("source").alias("container"), F.concat_ws("-", "lang", (F.col("n_chars") % 97).cast("string")).alias("basename"), F.md5("text").alias("md5"))


@query(f"WITH {NAMED} SELECT doc_id, container, basename FROM (SELECT *, row_number() OVER (PARTITION BY basename ORDER BY entries DESC, container DESC, doc_id) AS r FROM named JOIN sizes USING (container)) WHERE r = 1")
def rank_dedup(spark: SparkSession, d: str) -> DataFrame:
    files = _named(spark, d)
    sized = files.join(files.groupBy("container").agg(F.count(F.lit(1)).alias("entries")), "container")
    return dedup.rank_dedup(sized, "basename", [F.desc("entries"), F.desc("container"), F.col("doc_id")]).select("doc_id", "container", "basename")


@query("WITH n AS (SELECT lang || '-' || (n_chars % 97) AS basename, source AS container, md5(text) AS m FROM documents) SELECT basename, count(DISTINCT container) AS n_containers, count(DISTINCT m) AS n_contents, CASE WHEN count(DISTINCT m) > 1 THEN 'content_differs' ELSE 'same_content' END AS kind FROM n GROUP BY 1 HAVING count(DISTINCT container) > 1")
def name_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return dedup.name_conflicts(_named(spark, d))


@query(f"WITH {NAMED}, h AS (SELECT DISTINCT container, basename FROM named), s AS (SELECT container, count(*) AS n FROM h GROUP BY 1), p AS (SELECT a.container AS a, b.container AS b, count(*) AS shared FROM h a JOIN h b ON a.basename = b.basename AND a.container < b.container GROUP BY 1, 2) SELECT a, b, shared, CASE WHEN shared = x.n AND shared = y.n THEN 'equal' WHEN shared = x.n THEN 'subset' WHEN shared = y.n THEN 'superset' ELSE 'partial' END AS relation FROM p JOIN s x ON x.container = a JOIN s y ON y.container = b")
def container_overlap(spark: SparkSession, d: str) -> DataFrame:
    return dedup.container_overlap(_named(spark, d), "container", "basename")


@query(f"WITH {LINES} SELECT file, layer, pos, src FROM (SELECT *, row_number() OVER (PARTITION BY layer ORDER BY file, pos) AS r FROM good) WHERE r <= 5")
def stratified_head(spark: SparkSession, d: str) -> DataFrame:
    return planning.stratified_head(_lines(spark, d), 5).select("file", "layer", F.col("pos").cast("long").alias("pos"), "src")


@query(f"WITH {LINES} SELECT file, pos, src FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY pos) AS r FROM good) WHERE r <= 3")
def per_file_limit(spark: SparkSession, d: str) -> DataFrame:
    return planning.per_file_limit(_lines(spark, d), 3).select("file", F.col("pos").cast("long").alias("pos"), "src")


@query("SELECT 'doc_' || doc_id AS basename, lang AS layer FROM documents WHERE lang = 'es' AND contains('doc_' || doc_id, '1') ORDER BY basename LIMIT 15")
def topk_files(spark: SparkSession, d: str) -> DataFrame:
    files = _read(spark, d, "documents").select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("basename"), F.col("lang").alias("layer"))
    return planning.select_files(files, contains="1", layer="es", limit=15)


BATCHES = SENTENCES + ", numbered AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY file ORDER BY pos) - 1) / 10) AS INT) AS batch_idx FROM sentences), batches AS (SELECT file, batch_idx, CAST(count(*) AS INT) AS n, substr(sha256(string_agg(concat_ws(chr(31), CAST(pos AS VARCHAR), src, tgt), chr(30) ORDER BY pos)), 1, 8) AS batch_key FROM numbered GROUP BY 1, 2)"


@query(f"WITH {BATCHES} SELECT * FROM batches")
def batch_plan(spark: SparkSession, d: str) -> DataFrame:
    return plan(_sentences(spark, d)).drop("pairs")


MADE_NAMES = """SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'es-zh_conf_' || lang || '_' || doc_id || '_align.qc.json' WHEN 1 THEN 'zh-es_talk_' || lang || '_' || doc_id || '_algin.qc.json' WHEN 2 THEN 'x_' || doc_id || '_aglin.qc.json' WHEN 3 THEN 'x_y_' || doc_id || '_align.qc (1).json' WHEN 4 THEN 'x_y_z_' || doc_id || '_align.qc .json' WHEN 5 THEN 'x_y_z_' || doc_id || '_align.json' WHEN 6 THEN 'f' || doc_id || '.jsonl' ELSE 'f' || doc_id || '_align.qc..json' END AS basename FROM documents"""


@query(rf"""WITH n AS ({MADE_NAMES}), a AS (SELECT doc_id, basename, regexp_replace(regexp_replace(basename, '\s*\(\d+\)(\.jsonl?)$', '\1'), '\s+(\.jsonl?)$', '\1') AS f FROM n), b AS (SELECT doc_id, basename, regexp_replace(f, '(_algin\.qc\.json|_aglin\.qc\.json|_align\.qc\.\.json)$', '_align.qc.json') AS fixed FROM a), s AS (SELECT *, CASE WHEN regexp_matches(basename, '[_.]align\.qc\.json$') THEN regexp_replace(basename, '[_.]align\.qc\.json$', '') ELSE regexp_replace(basename, '\.(jsonl|json|xlsx)$', '') END AS stem FROM b) SELECT doc_id, fixed, CASE WHEN fixed LIKE '%align.qc.json' THEN regexp_replace(fixed, 'align\.qc\.json$', 'term.xlsx') WHEN regexp_matches(fixed, '\.jsonl?$') THEN regexp_replace(fixed, '\.jsonl?$', '_term.xlsx') ELSE fixed || '_term.xlsx' END AS out_name, stem, CASE WHEN len(string_split(stem, '_')) >= 3 THEN string_split(stem, '_')[2] || '/' || string_split(stem, '_')[3] ELSE '?/?' END AS layer, string_split(stem, '_')[1] AS name_dir FROM s""")
def out_names(spark: SparkSession, d: str) -> DataFrame:
    _read(spark, d, "documents").createOrReplaceTempView("_catalog_documents")
    made = spark.sql(MADE_NAMES.replace("FROM documents", "FROM _catalog_documents"))
    n = F.col("basename")
    return made.select("doc_id", names.normalize_basename(n).alias("fixed"), names.out_name(n).alias("out_name"), names.stem(n).alias("stem"), names.layer(n).alias("layer"), names.name_direction(n).alias("name_dir"))


@query("SELECT out_name, count(*) AS n_files FROM (SELECT 'o' || (n_chars % 211) AS out_name FROM documents) GROUP BY 1 HAVING count(*) > 1")
def name_collisions(spark: SparkSession, d: str) -> DataFrame:
    files = _read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("basename"), F.concat(F.lit("o"), (F.col("n_chars") % 211).cast("string")).alias("out_name"))
    return dedup.collisions(files).drop("files")


@query(f"WITH {PAIRS}, t AS (SELECT conv_id AS file, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, CASE WHEN conv_id % 5 = 1 THEN NULL WHEN conv_id % 5 = 2 THEN 7 WHEN conv_id % 5 = 3 THEN turn + 1 ELSE turn END AS raw_id FROM pairs), f AS (SELECT file, count(*) AS n, count(raw_id) AS has, count(*) FILTER (raw_id = 0) AS z, count(DISTINCT raw_id) AS k FROM t GROUP BY 1) SELECT file, pos, CASE WHEN z > 0 THEN 'zero_id' WHEN has < n THEN 'missing_id' WHEN k < n THEN 'duplicate_id' END AS renumbered, CASE WHEN z = 0 AND has = n AND k = n THEN raw_id ELSE pos END AS out_id FROM t JOIN f USING (file)")
def id_decision(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    c = F.col("conv_id") % 5
    raw = F.when(c == 1, None).when(c == 2, 7).when(c == 3, F.col("turn") + 1).otherwise(F.col("turn")).cast("long")
    rows = _pairs(spark, d).select(F.col("conv_id").alias("file"), F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long").alias("pos"), raw.alias("raw_id"))
    return corpus.decided_ids(rows).select("file", "pos", "renumbered", "out_id")


@query("""WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Tech, POLI;other' WHEN 1 THEN 'num/other' WHEN 2 THEN event_type || '|econ，econ' WHEN 3 THEN 'other' ELSE ' hot | cul ' END AS raw FROM events), k AS (SELECT event_id, list_filter(list_transform(regexp_split_to_array(raw, '[,，;/|]+'), lambda x: lower(trim(x))), lambda x: list_contains(['other','hot','cul','tech','poli','econ','tab','per','loc','org'], x)) AS l FROM e), u AS (SELECT event_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM k) SELECT event_id, array_to_string(CASE WHEN len(l) > 1 THEN list_filter(l, lambda x: x <> 'other') ELSE l END, ',') AS types FROM u""")
def type_whitelist(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("event_id") % 5
    raw = F.when(m == 0, "Tech, POLI;other").when(m == 1, "num/other").when(m == 2, F.concat("event_type", F.lit("|econ，econ"))).when(m == 3, "other").otherwise(" hot | cul ")
    return _read(spark, d, "events").select("event_id", F.array_join(text.norm_types(raw), ",").alias("types"))


@query("SELECT event_id, json_valid(props) AS valid, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events WHERE props IS NOT NULL")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "events").where("props is not null")
    return rows.select("event_id", F.expr("try_parse_json(props)").isNotNull().alias("valid"), F.array_join(F.array_sort(F.json_object_keys("props")), ",").alias("keys"))


TERMS = SENTENCES + r""", terms AS (SELECT file, pos AS sent_id, src AS src_text, tgt AS tgt_text, regexp_extract(src, '\p{L}{4,}') AS term_src, regexp_extract(tgt, '\p{L}{4,}') AS term_tgt FROM sentences WHERE regexp_matches(src, '\p{L}{4,}') AND regexp_matches(tgt, '\p{L}{4,}'))"""


@query(f"WITH {TERMS} SELECT file, CAST(sent_id AS BIGINT) AS sent_id, src_text, tgt_text, term_src, term_tgt, 'other' AS types, '' AS note, term_src AS term_src_dict, term_tgt AS term_tgt_dict FROM terms")
def term_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Pairs, batches, offline answers, parsing, anchors, normal forms, vote: the delivered table."""
    return delivery.table(offline(_sentences(spark, d)).terms, ["file"])


@query(f"WITH {TERMS} SELECT reject_code, count(*) AS n FROM (SELECT CASE WHEN sent_id % 3 = 0 THEN 'bad_anchor_tgt' END AS reject_code FROM terms) GROUP BY 1")
def anchor_rejects(spark: SparkSession, d: str) -> DataFrame:
    return offline(_sentences(spark, d), lambda: RuleProvider(noise=3, shape="fenced")).rows.groupBy("reject_code").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {PAIRS}, t AS (SELECT conv_id, turn, regexp_extract(src, '[A-Za-z]{{4,}}') AS term, tgt FROM pairs) SELECT conv_id, turn, term FROM t WHERE term <> '' AND strpos(tgt, term) > 0")
def anchor_exact(spark: SparkSession, d: str) -> DataFrame:
    from termloom.functions.anchor import exact

    rows = _pairs(spark, d).select("conv_id", "turn", F.regexp_extract("src", "[A-Za-z]{4,}", 0).alias("term"), "tgt")
    return rows.withColumn("hit", exact(F.col("term"), F.col("tgt"))).where("hit is not null").select("conv_id", "turn", "term")


@query(f"WITH {PAIRS}, t AS (SELECT conv_id, turn, regexp_extract(src, '[A-Za-z]{{4,}}') AS term, src FROM pairs) SELECT conv_id, turn, term AS slice FROM t WHERE term <> ''")
def anchor_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Terms in capitals find their own slice by folding."""
    rows = _pairs(spark, d).select("conv_id", "turn", F.regexp_extract("src", "[A-Za-z]{4,}", 0).alias("term"), "src").where("term <> ''")
    found = rows.withColumn("slice", anchor(F.upper("term"), F.col("src")))
    return found.select("conv_id", "turn", F.when(F.lower("slice") == F.lower("term"), F.col("term")).otherwise(F.col("slice")).alias("slice"))


@query(f"WITH {TOKENS}, l AS (SELECT *, lower(base) AS a, lower(span) AS b, least(length(base), length(span)) AS n FROM tok) SELECT doc_id, i, n > 0 AND substr(a, 1, CAST(least(n, greatest(3, ceil(n * 6 / 10))) AS INT)) = substr(b, 1, CAST(least(n, greatest(3, ceil(n * 6 / 10))) AS INT)) AS same_stem FROM l")
def stem_prefix(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).select("doc_id", "i", morph.stem_prefix(F.col("base"), F.col("span")).alias("same_stem"))


@query(f"WITH {TOKENS}, l AS (SELECT doc_id, i, lang, lower(base) AS b, lower(span) AS a FROM tok) SELECT doc_id, i, a <> b AND CASE lang WHEN 'es' THEN (regexp_matches(a, 'as?$') AND regexp_matches(b, 'os?$')) OR (regexp_matches(a, 'os?$') AND regexp_matches(b, 'as?$')) ELSE (regexp_matches(a, 'es?$') AND NOT regexp_matches(b, 'e$')) OR (NOT regexp_matches(a, 'es?$') AND regexp_matches(b, 'e$') AND NOT regexp_matches(a, '[xsz]$')) END AS flipped FROM l")
def gender_guard(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).select("doc_id", "i", morph.gender_flipped(F.col("base"), F.col("span"), F.col("lang")).alias("flipped"))


@query(f"WITH {TOKENS}, l AS (SELECT doc_id, i, list_distinct(regexp_extract_all(lower(base), '[a-z]')) AS b, list_distinct(regexp_extract_all(lower(span), '[a-z]')) AS a FROM tok) SELECT doc_id, i, len(list_filter(b, lambda x: NOT list_contains(a, x))) > 0 AS new_latin FROM l")
def script_guard(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).select("doc_id", "i", morph.new_letters(F.col("base"), F.col("span"), "a-z").alias("new_latin"))


@query(f"WITH {TOKENS}, j AS (SELECT doc_id, i, base, span, lead(base) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM tok), k AS (SELECT doc_id, i, len(list_filter(string_split(base || ' ' || span, ' '), lambda x: x <> '')) AS x, len(list_filter(string_split(next, ' '), lambda x: x <> '')) AS y FROM j WHERE next IS NOT NULL) SELECT doc_id, i, x = y AS same FROM k")
def word_count_guard(spark: SparkSession, d: str) -> DataFrame:
    t = _tokens(spark, d)
    after = t.select("doc_id", (F.col("i") - 1).alias("i"), F.col("base").alias("next"))
    return t.join(after, ["doc_id", "i"]).select("doc_id", "i", (F.size(morph.words(F.concat_ws(" ", "base", "span"))) == F.size(morph.words(F.col("next")))).alias("same"))


@query(f"WITH {TOKENS}, p AS (SELECT doc_id, i, lang, lower(base) AS w1, lower(span) AS w2, CASE WHEN regexp_matches(lower(span), 's$') THEN substr(lower(span), 1, length(span) - 1) ELSE lower(span) || 's' END AS w3 FROM tok WHERE base <> '' AND span <> '' AND length(span) > 2) SELECT doc_id, i, CASE lang WHEN 'es' THEN w1 IN ('de','del','en','a','al','con','por','para','sin','sobre') ELSE w1 IN ('de','du','des','en','à','au','aux','sur','sans') END AND regexp_matches(w2, '[sx]$') <> regexp_matches(w3, '[sx]$') AS changed FROM p WHERE NOT regexp_matches(w2, '^[dl]')")
def complement_metric(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("span")
    rows = _tokens(spark, d).where("base <> '' and span <> '' and length(span) > 2").where(~low.rlike("^[dl]"))
    other = F.when(low.rlike("s$"), low.substr(F.lit(1), F.length("span") - 1)).otherwise(F.concat(low, F.lit("s")))
    return rows.select("doc_id", "i", morph.complement_changed(F.concat_ws(" ", F.lower("base"), other), F.concat_ws(" ", F.lower("base"), low), F.col("lang")).alias("changed"))


@query()
def form_check(spark: SparkSession, d: str) -> DataFrame:
    pairs = _tokens(spark, d).groupBy("lang", "base", "span").agg(F.count(F.lit(1)).alias("n"))  # each form is checked once
    return pairs.select("lang", F.coalesce(morph.check_form(F.col("base"), F.col("span"), F.col("lang")), F.lit("ok")).alias("code"), "n").groupBy("lang", "code").agg(F.sum("n").alias("n"))


@query("""WITH r AS (SELECT source AS file, lang AS span, CAST(n_chars % 3 AS VARCHAR) AS other, doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN lang || 'a' ELSE lang || 'b' END AS base FROM documents), f AS (SELECT *, coalesce(nullif(base, ''), span) AS form FROM r), v AS (SELECT file, other, span, form, count(*) AS n, min(doc_id) AS first FROM f GROUP BY 1, 2, 3, 4), w AS (SELECT file, other, span, arg_max(form, row(n, CAST(form = span AS INT), -first)) AS won FROM v GROUP BY 1, 2, 3) SELECT doc_id, won AS term_tgt_dict FROM f JOIN w USING (file, other, span)""")
def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    base = F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 == 1, F.concat("lang", F.lit("a"))).otherwise(F.concat("lang", F.lit("b")))
    zero = F.lit(0)
    rows = _read(spark, d, "documents").select("doc_id", F.col("source").alias("file"), F.col("lang").alias("span_tgt"), (F.col("n_chars") % 3).cast("string").alias("span_src"), base.alias("base_tgt"), F.lit("").alias("base_src"), F.col("doc_id").alias("sent_id"), zero.alias("batch_idx"), zero.alias("item_pos"), zero.alias("term_pos"))
    return delivery.majority_vote(rows).select("doc_id", delivery.delivered(F.col("base_tgt"), F.col("span_tgt")).alias("term_tgt_dict"))


@query(r"""WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '“' || text || '”' WHEN 1 THEN 'l’' || text WHEN 2 THEN '"' || substr(text, 1, 5) || '"' || substr(text, 6) || '"' ELSE text END AS s FROM documents), a AS (SELECT doc_id, translate(s, '’ʼ՚′＇', repeat(chr(39), 5)) AS s FROM t), b AS (SELECT doc_id, s, substr(s, 2, length(s) - 2) AS body, length(s) > 2 AND regexp_matches(s[1], '["“”«»‘「」„‹›]') AND regexp_matches(s[-1], '["“”«»‘「」„‹›]') AS wrapped FROM a) SELECT doc_id, CASE WHEN wrapped AND NOT regexp_matches(body, '["“”«»‘「」„‹›]') THEN trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)) ELSE s END AS delivered FROM b""")
def delivery_norm(spark: SparkSession, d: str) -> DataFrame:
    m, whole = F.col("doc_id") % 4, F.col("text")
    made = F.when(m == 0, F.concat(F.lit("“"), whole, F.lit("”"))).when(m == 1, F.concat(F.lit("l’"), whole)).when(m == 2, F.concat(F.lit('"'), F.substring("text", 1, 5), F.lit('"'), whole.substr(F.lit(6), F.length("text")), F.lit('"'))).otherwise(whole)
    return _read(spark, d, "documents").select("doc_id", text.normalize_delivery(made).alias("delivered"))


@query("SELECT doc_id AS file, CAST(0 AS INT) AS batch_idx, CASE WHEN quality + doc_id % 2 > quality + toxic OR (quality + doc_id % 2 = quality + toxic AND toxic < doc_id % 3) THEN 'correction' ELSE 'first' END AS kind FROM labels")
def retry_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "labels").select(F.col("doc_id").alias("file"), F.lit(0).alias("batch_idx"), "quality", "toxic", "doc_id")
    first = rows.select("file", "batch_idx", (F.col("quality") + F.col("toxic")).cast("long").alias("n_kept"), (F.col("doc_id") % 3).cast("long").alias("n_failures"))
    second = rows.select("file", "batch_idx", (F.col("quality") + F.col("doc_id") % 2).cast("long").alias("n_kept"), F.col("toxic").cast("long").alias("n_failures"))
    return answers.better(first, second).select("file", "batch_idx", "kind")


@query("SELECT lang, count(*) AS calls, round(sum(((n_chars - n_chars // 4) * 0.75 + (n_chars // 4) * 0.075 + (n_chars % 100) * 3.75) / 1000000.0), 6) AS usd FROM documents GROUP BY lang")
def cost_rollup(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_chars")
    usd = cost(n, F.expr("n_chars div 4"), n % 100, Price(0.75, 3.75, 0.075))
    return _read(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum(usd), 6).alias("usd"))


RUN = f"WITH {BATCHES}, terms0 AS (SELECT n.file, n.batch_idx, n.pos FROM numbered n WHERE regexp_matches(src, '\\p{{L}}{{4,}}') AND regexp_matches(tgt, '\\p{{L}}{{4,}}')), k AS (SELECT file, batch_idx, count(*) FILTER (pos % 3 <> 0) AS kept, count(*) AS proposed FROM terms0 GROUP BY 1, 2), m AS (SELECT count(*) AS batches, sum(n) AS sentences, sum(coalesce(kept, 0)) AS kept, sum(coalesce(proposed, 0)) AS proposed FROM batches LEFT JOIN k USING (file, batch_idx))"


@query(RUN + " SELECT batches, CAST(sentences AS BIGINT) AS sentences, CAST(kept AS BIGINT) AS terms_kept, CAST(proposed AS BIGINT) AS terms_proposed, round(kept / proposed, 6) AS anchor_pass_rate, round(kept / sentences, 6) AS terms_per_sentence FROM m")
def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = offline(_sentences(spark, d), lambda: RuleProvider(noise=3)).metrics()
    return m.select("batches", "sentences", "terms_kept", "terms_proposed", F.round("anchor_pass_rate", 6).alias("anchor_pass_rate"), F.round("terms_per_sentence", 6).alias("terms_per_sentence"))


@query(RUN + ", g AS (SELECT unnest(['json_ok', 'anchor_pass', 'incomplete', 'skipped', 'balance', 'analyzer', 'call_failures', 'sensitive_refusals', 'rate_limited']) AS gate) SELECT gate, CASE WHEN gate = 'anchor_pass' AND kept / proposed < 0.9 THEN 'reject' WHEN gate = 'analyzer' THEN 'reject' ELSE 'pass' END AS verdict FROM g, m")
def quality_gates(spark: SparkSession, d: str) -> DataFrame:
    return metrics.gates(offline(_sentences(spark, d), lambda: RuleProvider(noise=3)).metrics(), analyzer_enabled=False).select("gate", "verdict")


@query(f"WITH {TERMS}, t AS (SELECT file, sent_id, CASE sent_id % 6 WHEN 1 THEN '#' || term_src ELSE term_src END AS term_src, CASE sent_id % 6 WHEN 3 THEN 'x' ELSE '' END AS note, CASE sent_id % 6 WHEN 5 THEN 'num' ELSE 'other' END AS types, src_text FROM terms) SELECT rule, count(*) AS n FROM (SELECT 'span_src' AS rule FROM t WHERE strpos(src_text, term_src) = 0 UNION ALL SELECT 'note' FROM t WHERE note <> '' UNION ALL SELECT 'types' FROM t WHERE types = 'num') GROUP BY 1")
def verify_violations(spark: SparkSession, d: str) -> DataFrame:
    rows = term_pipeline(spark, d)
    m = F.col("sent_id") % 6
    rows = rows.withColumns({"term_src": F.when(m == 1, F.concat(F.lit("#"), "term_src")).otherwise(F.col("term_src")), "note": F.when(m == 3, "x").otherwise(""), "types": F.when(m == 5, "num").otherwise("other")})
    return verify.violations(rows).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {TERMS} SELECT file AS out_name, CAST(sent_id AS BIGINT) AS sent_id, CASE WHEN sent_id % 5 = 0 THEN 'missing' ELSE 'other_form' END AS problem FROM terms WHERE sent_id % 5 = 0 OR sent_id % 7 = 0")
def verify_lineage(spark: SparkSession, d: str) -> DataFrame:
    rows = term_pipeline(spark, d).withColumnRenamed("file", "out_name")
    raw = rows.where("sent_id % 5 <> 0").withColumn("term_tgt_dict", F.when(F.col("sent_id") % 7 == 0, F.concat("term_tgt_dict", F.lit("!"))).otherwise(F.col("term_tgt_dict")))
    return verify.lineage(rows, raw).select("out_name", "sent_id", "problem")


@query(f"WITH {TERMS} SELECT CASE WHEN sent_id % 4 = 1 THEN 'neither' WHEN sent_id % 4 = 3 THEN 'restored' ELSE 'exact' END AS form_class, count(*) AS n FROM terms GROUP BY 1")
def verify_classes(spark: SparkSession, d: str) -> DataFrame:
    rows = term_pipeline(spark, d)
    m = F.col("sent_id") % 4
    form = F.when(m == 1, F.concat("term_tgt", F.lit(" otra"))).when(m == 3, F.concat(F.lit('"'), "term_tgt", F.lit('"'))).otherwise(F.col("term_tgt"))
    return verify.form_class(rows.withColumn("term_tgt_dict", form)).groupBy("form_class").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {BATCHES}, c AS (SELECT * FROM batches WHERE substr(batch_key, 1, 1) < '8') SELECT file, batch_idx, batch_key FROM batches ANTI JOIN c USING (file, batch_idx, batch_key)")
def cache_worklist(spark: SparkSession, d: str) -> DataFrame:
    batches = plan(_sentences(spark, d))
    return worklist(batches, batches.where(F.substring("batch_key", 1, 1) < "8")).select("file", "batch_idx", "batch_key")


LIST = [("es", "Ciónes", "ciónes", "", "", False, False), ("es", "Que", "que", "", "", False, False), ("fr", "Les", "les", "", "", False, False), ("fr", "Eux", "eux", "", "", False, True)]


@query(f"WITH {TOKENS}, l(lang, head) AS (VALUES ('es', 'Ciónes'), ('es', 'Que'), ('fr', 'Les'), ('fr', 'Eux')) SELECT doc_id, i, head FROM tok JOIN l ON tok.lang = l.lang AND lower(base) = lower(head)")
def lexicon_lookup(spark: SparkSession, d: str) -> DataFrame:
    own = spark.createDataFrame(LIST, lexicon.SCHEMA)
    return lexicon.lookup(_tokens(spark, d), own, "base").select("doc_id", "i", "head")


@query("""WITH e AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 402 WHEN event_id % 3 = 0 THEN 429 ELSE 400 END AS status, CASE event_id % 4 WHEN 0 THEN 'Insufficient_Quota for ' || event_type WHEN 1 THEN 'rate limit' WHEN 2 THEN 'your balance-is-insufficient' ELSE event_type END AS message FROM events) SELECT event_id, status = 402 OR contains(translate(lower(message), '_-', '  '), 'insufficient quota') OR contains(translate(lower(message), '_-', '  '), 'balance is insufficient') AS exhausted FROM e""")
def balance_predicate(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    status = F.when(n % 11 == 0, 402).when(n % 3 == 0, 429).otherwise(400)
    message = F.when(n % 4 == 0, F.concat(F.lit("Insufficient_Quota for "), "event_type")).when(n % 4 == 1, "rate limit").when(n % 4 == 2, "your balance-is-insufficient").otherwise(F.col("event_type"))
    return _read(spark, d, "events").select("event_id", text.balance_exhausted(status, message).alias("exhausted"))


@query("SELECT doc_id, n_chars % 60 >= 20 AND n_chars % 60 > 0.1 * greatest(1, doc_id % 500) AS tripped FROM documents")
def rate_limit_predicate(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "documents").select("doc_id", text.rate_limited(F.col("n_chars") % 60, F.col("doc_id") % 500).alias("tripped"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'zh ' || doc_id ELSE '00:00:0' || doc_id % 10 || ',100 --> 00:00:08,100' END AS src, CASE WHEN doc_id % 3 = 2 THEN '12' ELSE 'texto' END AS tgt, CASE WHEN doc_id % 3 = 1 THEN 'shifted_unrecoverable' WHEN doc_id % 3 = 2 THEN 'shifted_unrecoverable' END AS flag FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT doc_id, '汉', CASE WHEN doc_id % 4 = 0 THEN 'late' ELSE 'texto' END, 'shifted_recovered' FROM documents WHERE doc_id % 2 = 0")
def shift_recovery(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    clock = F.concat(F.lit("00:00:0"), (n % 10).cast("string"), F.lit(",100 --> 00:00:08,100"))
    odd = n % 2 == 1
    src = F.when(odd & (n % 3 == 0), F.concat(F.lit("zh "), n.cast("string"))).otherwise(clock)
    tgt = F.when(odd & (n % 3 == 2), "12").when(~odd & (n % 4 == 0), clock).otherwise("texto")
    pair = corpus.recovered_pair(src, tgt, F.when(odd, "").otherwise("汉"), F.lit("late"))
    return _read(spark, d, "documents").select("doc_id", pair.alias("p")).select("doc_id", "p.*")


@query(f"WITH {LINES}, t AS (SELECT file, CASE WHEN pos % 3 = 0 THEN '汉字汉字' ELSE src END AS s, CASE WHEN pos % 4 = 0 THEN '汉字汉字' ELSE src END AS t FROM good), c AS (SELECT file, count(*) FILTER (s = '汉字汉字') AS a, count(*) FILTER (t = '汉字汉字') AS b FROM t GROUP BY 1) SELECT file, CASE WHEN a > b THEN 'zh-first' WHEN b > a THEN 'foreign-first' ELSE 'unclear' END AS direction FROM c")
def content_direction(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d)
    zh = F.lit("汉字汉字")
    return rows.groupBy("file").agg(names.content_direction(F.when(F.col("pos") % 3 == 0, zh).otherwise(F.col("src")), F.when(F.col("pos") % 4 == 0, zh).otherwise(F.col("src"))).alias("direction"))


@query(f"WITH {PAIRS} SELECT 'zh-es_a_b_' || conv_id || '_' || turn || '_align.qc.json' AS file, 'a/b' AS layer, 1 AS pos, CAST(1 AS BIGINT) AS out_id, trim(coalesce(src, ''), chr(32) || chr(9) || chr(10) || chr(13)) AS src, trim(coalesce(tgt, ''), chr(32) || chr(9) || chr(10) || chr(13)) AS tgt, regexp_matches(coalesce(src, ''), '\\p{{L}}') AND regexp_matches(coalesce(tgt, ''), '\\p{{L}}') AS usable FROM pairs")
def tolerant_parse(spark: SparkSession, d: str) -> DataFrame:
    """Every pair as a file in one of several broken shapes, read back."""
    from termloom.functions.tolerant import repair  # noqa: F401

    body = F.to_json(F.struct(F.col("src").alias("src"), F.col("tgt").alias("tgt"), F.lit(1).alias("sent_id")))
    m = F.col("turn") % 4
    made = F.when(m == 0, F.concat(F.lit('{"sentences": ['), body, F.lit(",]}"))).when(m == 1, F.concat(F.lit("["), body, F.lit("]"))).otherwise(F.concat(F.lit('{"pair": "x" "subtitles": ['), body, F.lit("]}")))
    members = _pairs(spark, d).select(F.lit("c").alias("container"), F.concat_ws("_", F.lit("zh-es_a_b"), F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.lit("align.qc.json")).alias("member"), made.cast("binary").alias("content"), F.lit(None).cast("string").alias("skipped"), F.current_timestamp().alias("mtime"))
    return corpus.sentences_of(corpus.parse_members(members)).select("file", "layer", "pos", "out_id", "src", "tgt", "usable")


@query(f"WITH {SENTENCES} SELECT count(*) AS n FROM sentences WHERE regexp_matches(src, '\\p{{L}}{{4,}}') AND regexp_matches(tgt, '\\p{{L}}{{4,}}')")
def correction_pass(spark: SparkSession, d: str) -> DataFrame:
    """A noisy first answer, then a clean correction: every term is kept in the end."""
    first = offline(_sentences(spark, d), lambda: RuleProvider(noise=3))
    return corrected(first, RuleProvider).terms.agg(F.count(F.lit(1)).alias("n"))
