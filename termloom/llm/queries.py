"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termloom.llm.common import table


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from termloom.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.secretscan import secret_spans

    return secret_spans(table(spark, sf_dir, "documents")).drop("base", "found")


def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"))


def op4_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.license import license_notices

    return license_notices(table(spark, sf_dir, "documents"))


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.mixing import mixture

    return mixture(table(spark, sf_dir, "documents"), budget=1.0, repeats=1.5)


def op6_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.htmltext import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(), keep_ids=False, keep_offsets=False)


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), size=20, keep_text=False)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op10_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.jaccard import similar

    return similar(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.fim import fill_in_middle

    return fill_in_middle(table(spark, sf_dir, "documents"), plain=10, spm=20, seed=1, keep_text=False)


def op12_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.suffixes import remove_strings

    return remove_strings(table(spark, sf_dir, "documents"), size=200, keep_text=False)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termloom.llm.collocations import collocations, ranked

    return ranked(collocations(table(spark, sf_dir, "documents"), longest=5, least=100, share=100), most=2000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By name: every function of this module called opN_<name>."""
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


WORDS = r"""words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents)"""

OP8 = (
    "WITH "
    + WORDS.format(text="text")
    + """, windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k FROM words, unnest(range(1, greatest(1, len(ws) - 18))) AS r(i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, unnest(range(0, 20)) AS s(j)),
placed AS (SELECT doc_id, p, ws[p] AS w FROM words, unnest(range(1, len(ws) + 1)) AS s(p)),
left_over AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS kept FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM words LEFT JOIN left_over USING (doc_id)"""
)

OP10 = (
    "WITH RECURSIVE "
    + WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    + """, shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS s FROM words, unnest(range(1, greatest(2, len(ws) - 1))) AS r(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, least(doc_id, coalesce(min(m), doc_id)) AS component_id, coalesce(max(k), 0) AS n_links FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT x AS doc_id, count(*) AS k FROM links GROUP BY 1) USING (doc_id) GROUP BY doc_id"""
)


OP11 = r"""WITH units AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS us, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, us, len(us) AS n, [CAST('0x' || substr(h, i, 8) AS UBIGINT) FOR i IN [1, 9, 17, 25]] AS d FROM units),
cut AS (SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS x, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS y, CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR d[3] % 100 >= 90 THEN 'plain' WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT doc_id, t, n, form, array_to_string(us[1:x], '') AS p, array_to_string(us[x + 1:y], '') AS m, array_to_string(us[y + 1:n], '') AS s FROM cut),
made AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM parts),
back AS (SELECT *, CASE form WHEN 'plain' THEN output WHEN 'psm' THEN regexp_replace(output, '^<P>(.*?)<S>(.*?)<M>(.*)$', '\1\3\2', 's') ELSE regexp_replace(output, '^<S>(.*?)<P>(.*?)<M>(.*)$', '\2\3\1', 's') END AS again FROM made)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(output) AS output_sha256, sha256(again) AS restored_sha256 FROM back"""


OP12 = """WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT doc_id, a, substr(h, 2 * a + 1, 4398) AS h FROM hexed, unnest(range(0, length(h) // 2, 2000)) AS q(a)),
bytes AS (SELECT doc_id, a + j AS i, substr(h, 2 * j - 1, 2) AS b, CASE WHEN 2 * j + 398 <= length(h) THEN md5(substr(h, 2 * j - 1, 400)) END AS k FROM pieces, unnest(range(1, least(2000, length(h) // 2) + 1)) AS r(j)),
often AS (SELECT k FROM bytes WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1),
marked AS (SELECT doc_id, i, b, often.k IS NOT NULL AS again FROM bytes LEFT JOIN often USING (k)),
under AS (SELECT doc_id, i, b, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone FROM marked),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM under)
SELECT doc_id, count(i) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans, sha256(unhex(coalesce(string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone), ''))) AS kept_sha256 FROM documents LEFT JOIN edges USING (doc_id) GROUP BY doc_id"""


OP13 = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM worded GROUP BY 1),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM worded, unnest(range(1, len(ws) + 1)) AS q(i), unnest(range(1, 6)) AS s(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, n, j, l.a AS l, r.a AS r, (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS score FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) AS c JOIN totals USING (lang) JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:j], ' ') JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
parts AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM candidates, unnest(range(1, 5)) AS q(i), unnest(range(2, 5)) AS s(m) WHERE m < k AND i + m - 1 <= k GROUP BY 1, 2),
left_over AS (SELECT best.* FROM best LEFT JOIN parts USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
placed AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM left_over)
SELECT * FROM placed WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators whose whole result SQL can state; tests/llm holds the others against brute force."""
    return {"op8_fm_index": OP8, "op10_prefix_join": OP10, "op11_fill_in_middle": OP11, "op12_suffix_family": OP12, "op13_phrase_collocations": OP13}
