"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.llm import extraction
from feedloom.llm.common import table
from feedloom.llm.decontamination import find_leaks
from feedloom.llm.language_id import held_out, predict, train
from feedloom.llm.language_model import score_texts
from feedloom.llm.merkle import folded, leaf_of, manifest, siblings_digest
from feedloom.llm.packing import pack
from feedloom.llm.repeats import without_repeats
from feedloom.llm.secrets import KINDS, OWNED, find_secrets
from feedloom.llm.simhash import hex_of, near_duplicates
from feedloom.llm.sketches import compared_with_next
from feedloom.llm.spelling import spelling_variants
from feedloom.llm.token_file import round_trip
from feedloom.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: DuckDB SQL of those that SQL can express.
SQL: dict[str, str] = {}


def tokenizer() -> str:
    """The public byte-level BPE vocabulary; the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out("doc_id", 7, 2)
    found = score_texts(table(spark, sf_dir, "documents"), F.col("doc_id").isNotNull() & ~out, order=3)
    return found.select(
        F.col("id").alias("doc_id"), held_out("id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select(found.id.alias("doc_id"), hex_of("fingerprint").alias("fingerprint"), "component_id")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer(), capacity=1024, end_id=0, added=True).withColumnRenamed("id", "doc_id")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL["op4_decontamination"] = r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
        SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    v AS (
        SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS phrase
        FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
    a AS (
        SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS phrase
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM v))),
    o AS (SELECT doc_id, p, n, item FROM a JOIN v USING (n, phrase)),
    h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
        SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM o)) GROUP BY doc_id),
    i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query
def op5_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(
        table(spark, sf_dir, "pages"), allow=["org/", "com/fr/"], block=["example.org/es/", "example.org/en/1", "com/de/"],
    ).withColumnRenamed("id", "page_id")


@query
def op6_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(column: str):
        return F.lower(F.hex(column))

    return compared_with_next(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", written("sketch").alias("fingerprint"),
        written("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer(), end_id=2, added=True).withColumnRenamed("id", "doc_id")


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), max_owners=2)
    names = F.array(*map(F.lit, KINDS))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.concat_ws(",", F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))

    return found.select(
        F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != OWNED)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), count(OWNED).alias("n_owned"),
        F.size(F.filter("spans", lambda s: ~s["owned"])).cast("long").alias("n_examples"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = held_out("doc_id", 3, 1)
    model = train(docs.where(F.col("doc_id").isNotNull() & ~test))
    return predict(docs, model).select(
        F.col("id").alias("doc_id"), held_out("id", 3, 1).alias("held_out"), F.col("label").alias("lang_pred"), "score")


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages)).withColumnRenamed("id", "page_id")


@query
def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), window=20).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op11_repeats"] = r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    a AS (
        SELECT doc_id, row, p, array_to_string(w[p:p + 19], ' ') AS passage
        FROM (SELECT doc_id, row, w, unnest(range(1, len(w) - 18)) AS p FROM d)),
    r AS (
        SELECT row, p FROM (
            SELECT row, p, rank() OVER (PARTITION BY passage ORDER BY doc_id NULLS FIRST, p) AS place FROM a) WHERE place > 1),
    g AS (SELECT DISTINCT row, unnest(range(p, p + 20)) AS q FROM r),
    k AS (
        SELECT d.row, string_agg(d.word, ' ' ORDER BY d.q) AS kept, count(*) AS n_kept
        FROM (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d) d ANTI JOIN g ON d.row = g.row AND d.q = g.q
        GROUP BY d.row)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (row)
"""


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), least_length=5, least_count=3, drop_every=97)


#: Fields of a leaf of the documents' manifest.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    now = F.col("n_chars") + F.when(changed, 1).otherwise(0)
    found = manifest(
        docs, LEAF, "lang", "doc_id", fanout=2, keep={"now": leaf_of([now if f == "n_chars" else F.col(f) for f in LEAF])})
    root = folded(F.col("now"), F.col("path"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"),
        root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(n_chars: str) -> str:
    fields = [f"CAST({n_chars if f == 'n_chars' else f} AS VARCHAR)" for f in LEAF]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + "))"


def _climb_sql(name: str, tree: str, leaves: str) -> str:
    """All nodes (tree, l, p, d, c) over ``leaves`` (tree, p, d, c): level, place, digest, and how many there are."""
    return f"""
    {name} AS (
        SELECT {tree}, 0 AS l, p, d, c FROM {leaves}
        UNION ALL
        SELECT {tree}, l + 1, p // 2, sha256(string_agg(d, '' ORDER BY p)), (c + 1) // 2
        FROM {name} WHERE c > 1 GROUP BY {tree}, l, p // 2, c)"""


def _walk_sql(name: str, tree: str, leaves: str, nodes: str) -> str:
    """From each of ``leaves`` (tree, row, p, f, proof) up: the folded digest and the siblings so far."""
    return f"""
    {name} AS (
        SELECT {tree}, row, 0 AS l, p, f, proof FROM {leaves}
        UNION ALL
        SELECT {', '.join('w.' + t for t in tree.split(', '))}, w.row, w.l + 1, w.p // 2,
            sha256(CASE WHEN w.p % 2 = 1 THEN s.d || w.f ELSE w.f || coalesce(s.d, '') END), w.proof || coalesce(s.d, '')
        FROM {name} w JOIN {nodes} n ON {' AND '.join(f'w.{t} = n.{t}' for t in tree.split(', '))} AND w.l = n.l AND w.p = n.p
        LEFT JOIN {nodes} s ON {' AND '.join(f's.{t} = n.{t}' for t in tree.split(', '))} AND s.l = n.l AND s.p = xor(n.p, 1)
        WHERE n.c > 1)"""


def _crc32_sql(byte_list: str) -> str:
    """CRC-32 of a list of bytes, bit by bit."""
    bits = "list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[])"
    step = f"list_reduce({bits}, lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {byte_list}), lambda a, b: {step}), 4294967295::UBIGINT)"


#: Bytes of a text without characters beyond U+00FF.
_BYTES_SQL = """flatten(list_transform(string_split({}, ''), lambda q: CASE WHEN ascii(q) < 128 THEN [ascii(q)::UBIGINT]
    ELSE [(192 + (ascii(q) >> 6))::UBIGINT, (128 + (ascii(q) & 63))::UBIGINT] END))"""


SQL["op12_spelling"] = rf"""
    WITH RECURSIVE o AS (
        SELECT id, run, count(*) AS n FROM (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY id, run),
    h AS (SELECT run, n, {_crc32_sql(_BYTES_SQL.format("(id || ':' || run)"))} AS h FROM o),
    v AS MATERIALIZED (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT n, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                ELSE run END AS word FROM h)
        WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    c AS MATERIALIZED (
        SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
    e AS (
        SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM c x JOIN c y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION SELECT x.word, x.n, y.word, y.n FROM c x JOIN v y ON x.a || x.b = y.word
        UNION SELECT y.word, y.n, x.word, x.n FROM c x JOIN v y ON x.a || x.b = y.word),
    t AS (
        SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM e GROUP BY word, n),
    f AS MATERIALIZED (
        SELECT v.word, CASE WHEN near_n >= 2 * v.n THEN near END AS form, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
            CASE WHEN near_n >= 2 * v.n THEN near_n END::BIGINT AS form_n
        FROM v LEFT JOIN t ON v.word = t.word),
    r AS (
        SELECT word, word AS root FROM f WHERE form IS NULL
        UNION ALL SELECT f.word, r.root FROM f JOIN r ON f.form = r.word)
    SELECT f.word, form, root, n, n_near, form_n FROM f JOIN r ON f.word = r.word
"""

SQL["op13_manifest"] = f"""
    WITH RECURSIVE leaves AS MATERIALIZED (
        SELECT doc_id, row_number() OVER () AS row, coalesce(lang, '') AS g, lang IS NOT NULL AS k, {_leaf_sql('n_chars')} AS leaf,
            {_leaf_sql(f"(n_chars + (CASE WHEN {_crc32_sql(_BYTES_SQL.format('doc_id::VARCHAR'))} % 7 = 0 THEN 1 ELSE 0 END))")} AS now
        FROM documents),
    low AS MATERIALIZED (
        SELECT *, leaf AS d, row_number() OVER (PARTITION BY k, g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
            count(*) OVER (PARTITION BY k, g) AS c FROM leaves),
    {_climb_sql('low_nodes', 'k, g', 'low')},
    tops AS MATERIALIZED (
        SELECT k, g, d, 0 AS tree, row_number() OVER (ORDER BY k, encode(g)) - 1 AS p, count(*) OVER () AS c FROM low_nodes WHERE c = 1),
    {_climb_sql('top_nodes', 'tree', 'tops')},
    {_walk_sql('low_walk', 'k, g', "(SELECT k, g, row, p, now AS f, '' AS proof FROM low)", 'low_nodes')},
    low_end AS MATERIALIZED (
        SELECT w.row, 0 AS tree, t.p, w.f, w.proof, t.d AS subroot FROM (
            SELECT *, row_number() OVER (PARTITION BY row ORDER BY l DESC) AS place FROM low_walk) w
        JOIN tops t ON w.k = t.k AND w.g = t.g WHERE place = 1),
    {_walk_sql('top_walk', 'tree', '(SELECT tree, row, p, f, proof FROM low_end)', 'top_nodes')},
    top_end AS (
        SELECT row, f, proof FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY l DESC) AS place FROM top_walk) WHERE place = 1),
    root AS (SELECT d AS root FROM top_nodes WHERE c = 1)
    SELECT doc_id, leaf, subroot, root, sha256(top_end.proof) AS proof_sha256, top_end.f AS folded_root, top_end.f = root AS verified
    FROM leaves JOIN low_end USING (row) JOIN top_end USING (row), root
"""
