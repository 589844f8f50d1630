"""One query for each operator, over its whole table, by the digests that the contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import chat, fim, importance, language_id, neighbours, quality
from clickloom.llm.decontamination import find_contamination
from clickloom.llm.jaccard import similar_groups
from clickloom.llm.packing import pack_documents
from clickloom.llm.shared import shared_folder, staged
from clickloom.llm.sharding import read_shards, write_shards
from clickloom.llm.substring_dedup import remove_repeated_words
from clickloom.llm.suffix_dedup import remove_repeated_bytes
from clickloom.llm.token_files import read_documents, write_token_files
from clickloom.sources.tables import load


def byte_bpe() -> str:
    """The tokenizer of the production queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Learned on the documents outside the held-out fourth."""
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.train(docs.filter(~held_out))
    out = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", "text")
    out = remove_repeated_words(docs, window=50)
    return out.select("row.doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = load(spark, sf, "documents"), load(spark, sf, "benchmark")
    found = find_contamination(docs.select("doc_id", "text"), items.select("item_id", "text"))
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", "text")
    out = remove_repeated_bytes(docs, length=200)
    return out.select("row.doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    turns = load(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    # One conversation more, made of the format's own control strings.
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.read_back(chat.format_conversations(turns.unionByName(more)))


def op6_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_groups(load(spark, sf, "documents").select("doc_id", "text"), words=3, percent=90)


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", "text")
    measured = staged(quality.measure(docs))
    forest = quality.fit_measured(measured, load(spark, sf, "labels"))
    return quality.judge_measured(measured, forest).select("row.doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", "text")
    folder = shared_folder(spark)
    write_shards(docs, folder, shards=8)
    text = F.coalesce("row.text", F.lit(""))
    return read_shards(spark, folder, docs).select(
        "row.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    write_token_files(load(spark, sf, "documents").select("doc_id", "text"), folder, byte_bpe(), end_id=0)
    return read_documents(spark, folder)


def op10_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(load(spark, sf, "documents").select("doc_id", "text"), byte_bpe(), capacity=2048, end_id=0)


def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    store = staged(fim.to_frames(load(spark, sf, "documents").select("doc_id", "text")))
    told = fim.digests(fim.fill_in_middle(store, seed=1, transformed_percent=90, spm_percent=20))
    return told.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op12_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    docs, target = load(spark, sf, "documents").select("doc_id", "text"), load(spark, sf, "benchmark").select("item_id", "text")
    told = importance.resample(docs, target, percent=25, least_words=20, buckets=10_000, longest=2, seed=7)
    return told.select("row.doc_id", "n_features", "weight", "score", "rank")


def op13_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    index = neighbours.build(load(spark, sf, "embeddings").select("vec_id", "embedding"))
    return neighbours.search(index, F.col("id") % 50 == 0, k=5)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_substring_dedup,
        op3_decontamination,
        op4_suffix_dedup,
        op5_chat_formatting,
        op6_jaccard_join,
        op7_quality_rules,
        op8_sharding,
        op9_token_files,
        op10_best_fit_packing,
        op11_fill_in_middle,
        op12_importance_resampling,
        op13_nearest_neighbours,
    )
}
#: Words between blanks, as a list; a null text has none.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
#: Lower-cased words of letters and digits.
_ALNUM = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _escaped(column: str) -> str:
    once = rf"regexp_replace(coalesce({column}, ''), '(<\\*)(/?s>)', '\1\\\2', 'g')"
    return rf"regexp_replace({once}, '(\[\\*)(/?INST\])', '\1\\\2', 'g')"


ORACLES: dict[str, str] = {
    "op2_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        s AS (SELECT doc_id, unnest(generate_series(1, len(w) - 49)) AS i, w FROM d WHERE len(w) >= 50),
        windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
        later AS (SELECT doc_id, i FROM windows JOIN (SELECT h, min(doc_id) AS least FROM windows GROUP BY h) USING (h) WHERE doc_id > least),
        gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS k FROM later),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op3_decontamination": f"""
        WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
        b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
        bs AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
        bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM bs),
        lengths AS (SELECT DISTINCT n FROM bw),
        ds AS (SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n),
        hits AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM ds) JOIN bw USING (n, t)),
        words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS t
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_chat_formatting": f"""
        WITH turns AS (
            SELECT conv_id::BIGINT AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<s>[INST] ') + length({_escaped("role")}) + length(' [/INST] ') + length({_escaped("text")}) + length('</s>'))::BIGINT
                   AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op6_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM w WHERE len(w) > 0),
        sets AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ') || least(len(w), 3)) AS h FROM s),
        sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b USING (h) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS MATERIALIZED (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common.n >= 90 * (x.n + y.n - common.n)),
        ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)""",
    "op11_fill_in_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS x FROM documents),
        h AS (SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS b,
                     ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
        f AS (SELECT doc_id, text, n, least(a, b) AS i, greatest(a, b) AS j,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        parts AS (SELECT *, substr(text, 1, i) AS p, substr(text, i + 1, j - i) AS m, substr(text, j + 1) AS s FROM f)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN i::BIGINT END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN (j - i)::BIGINT END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                      ELSE text END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
    "op12_importance_resampling": f"""
        WITH codes AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
                              ORDER BY i) AS t FROM range(256) r(i)),
        w AS (SELECT doc_id AS id, false AS target, {_ALNUM} AS w FROM documents UNION ALL SELECT item_id, true, {_ALNUM} FROM benchmark),
        f AS (SELECT id, target, unnest(w) AS f FROM w
              UNION ALL SELECT id, target, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
        counted AS MATERIALIZED (SELECT id, target, f, count(*) AS n FROM f GROUP BY ALL),
        spelt AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counted)),
        hashed AS MATERIALIZED (
            SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                                                  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
            FROM spelt, codes),
        sums AS (SELECT bucket, coalesce(sum(n) FILTER (NOT target), 0) AS s, coalesce(sum(n) FILTER (target), 0) AS t FROM counted JOIN hashed USING (f) GROUP BY bucket),
        gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums)::DOUBLE + 10000) / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums)::DOUBLE + 10000))))::BIGINT AS gain FROM sums),
        weights AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::BIGINT / sum(n)::BIGINT)::BIGINT AS weight
                    FROM counted JOIN hashed USING (f) JOIN gains USING (bucket) WHERE NOT target GROUP BY id),
        scored AS (SELECT id AS doc_id, len(w) >= 20 AS takes_part, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                          coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
                   FROM w LEFT JOIN weights USING (id) WHERE NOT target),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE takes_part)
        SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op13_nearest_neighbours": """
        WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        u AS (SELECT vec_id, e, sqrt(list_reduce(list_prepend(0::DOUBLE, list_transform(e, lambda x: x * x)), lambda a, b: a + b)) AS norm FROM v
              WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id,
                         list_reduce(list_prepend(0::DOUBLE, list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), lambda a, b: a + b) / q.norm / c.norm AS score
                  FROM u q JOIN u c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 AND q.norm > 0 AND c.norm > 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
        SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5""",
}
